"""Wall time of the headline queries: one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, and ``BENCH_ALL=1`` runs every
registered query. Each result is computed in full and thrown away. Every query runs once untimed
before, so that class loading and code generation are not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = """
src01_parquet_scan src05_hive_partition_scan src06_json_text_scan snk05_compact_files
snk15_materialized_view snk18_keyed_upsert snk19_apply_changes prj09_feels_like prj12_surrogate_key flt05_token_search
flt06_index_search flt09_partition_lookup jn01_star_join jn04_pair_events jn05_dimension_twice jn06_interval_load
jn06_count_in_intervals jn08_supply_gap jn09_nearest_point jn13_aggregate_then_join ag01_group_by ag04_count_distinct
ag05_time_histogram ag11_pivot ag13_compare_windows ag18_customer_profile ag21_job_cost wn01_rank_with_ties wn04_period_change
wn05_running_sum so03_top_k fn_j2_path_access fn_g1_distance st06_tumbling_bucket st08_pair_trips st09_dashboard
ml04_anomalies ml05_churn_features ml10_forecast vs02_vector_search vs04_entity_matching tx01_text_inference
tx04_chunk_documents dq01_column_profile dq06_duplicates dq07_rule_bindings dq14_sensitive_scan dq20_anonymize_table
pl01_high_value_orders pl02_weekly_report pl03_behaviour_profile pl04_delivery_shortage pl05_order_normalisation
pl06_sales_mart pl09_nearest_weather pl10_cost_comparison
""".split()


def ratios(spark, folder: str) -> dict[str, float]:
    """Seconds of the plain way over seconds of the prepared way, on structures built beforehand."""
    from pyspark.sql import functions as F

    from tidemark.functions.search import search_columns
    from tidemark.operators import joins as j, text_index as x, vectors as v
    from tidemark.plans.learning import PROBED, hundredth_queries, vector_index
    from tidemark.session import Tables, materialize, scratch_path
    from tidemark.sources import changes as ch, tables as w

    t = Tables(spark, folder)

    def spent(df_of) -> float:
        best = None
        for _ in range(3):
            start = time.perf_counter()
            df_of().write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        return best

    keys, sums = [F.col("l_returnflag"), F.to_date("l_shipdate").alias("day")], {"q": F.col("l_quantity"), "p": F.col("l_extendedprice")}
    view = materialize(ch.create_mv(t.lineitem, keys, sums), "view")
    index = x.kept_index(t.documents, ["text"])
    small, few = scratch_path(spark, "small"), scratch_path(spark, "few")
    w.write_table(t.lineitem.repartition(400), small)
    w.compact(spark, small, few, 8)
    spans = materialize(t.events.select("event_type", F.floor(F.unix_timestamp("ts") / 60).alias("lo"), "value").withColumn("hi", F.col("lo") + 720), "spans")
    codebook, lists = vector_index(t)
    queries = materialize(hundredth_queries(t), "queries")
    pairs = {
        "view": (lambda: t.lineitem.groupBy("l_returnflag", F.year("l_shipdate")).agg(F.sum("l_quantity"), F.sum("l_extendedprice")),
                 lambda: view.groupBy("l_returnflag", F.year("day")).agg(F.sum("q"), F.sum("p"))),
        "index_needle": (lambda: t.documents.filter(search_columns(t.documents, ["text"], "license")).select("doc_id"),
                         lambda: x.find_rows(index, "license")),
        "compaction": (lambda: spark.read.parquet(small).groupBy("l_returnflag").sum("l_quantity"),
                       lambda: spark.read.parquet(few).groupBy("l_returnflag").sum("l_quantity")),
        "interval_sweep": (lambda: spans.withColumn("m", F.explode(F.sequence("lo", "hi"))).groupBy("event_type", "m").agg(F.sum("value")),
                           lambda: j.interval_load(spans, ["event_type"], "lo", "hi", "value")),
        "probed_vectors": (lambda: v.vector_search(t.embeddings, queries, 5, "euclidean", b_id="vec_id", q_vec="q"),
                           lambda: v.search_index(lists, codebook, queries, 5, PROBED, q_vec="q")),
    }
    return {name: round(spent(plain) / spent(prepared), 2) for name, (plain, prepared) in pairs.items()}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    from tidemark.plans import QUERIES
    from tidemark.session import local_session

    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    times = {}
    for name in names:
        for timed in (False, True):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
        times[name] = round(spent, 3)
        print(f"{spent:8.2f}s {name}", file=sys.stderr, flush=True)
    found = ratios(spark, folder)
    print(json.dumps({
        "metric": "headline_queries_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "ratios": found, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
