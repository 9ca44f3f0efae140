"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_KEYS (comma separated, or
``all``) other queries than the headline ones. Every result row is computed and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time

from millrace.plans.catalog import QUERIES
from millrace.session import build

# At least one query per block; long iterative fits are left to BENCH_KEYS.
HEADLINE = """
src_csv_schema src_csv_multiline src_delimited_parse src_parquet sink_partitioned_insert
proj_select_expr filter_compound case_when distinct_values layout_repartition
join_inner join_left join_array_contains join_kv_partitions join_stats_back join_spine_fill join_multi_key
agg_group_having agg_count_distinct agg_collect agg_group agg_two_stage agg_rollup agg_cube agg_pivot
agg_describe agg_quantile agg_mode agg_corr_matrix agg_chi2 agg_histogram agg_custom_reduce
win_rank win_running_avg win_moving_avg win_change_with_avg win_zscore_outlier
sort_multi topk_global topk_per_group set_union_by_name sample_by_key split_hash
str_regex str_clean_punct math_arith date_parse_format null_drop_fill cx_explode
txt_word_count txt_char_count txt_strip_html txt_count_tfidf txt_zero_shot txt_few_shot_knn txt_token_ids
txt_extract_summary txt_next_token
fe_string_index fe_standard_scale fe_impute fe_label_vs_group_mean fe_pca ml_linear_reg ml_kmeans
eval_regression eval_binary_curves eval_residuals
fc_history fc_seasonal_native fc_grouped_map fc_evaluate fc_report
stream_files stream_kmeans
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_KEYS", "")
    keys = list(QUERIES) if wanted == "all" else (wanted.split(",") if wanted else HEADLINE)
    spark = build(f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's and the workers' machinery outside the timings.
    QUERIES["agg_group_having"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for key in keys:
        start = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.perf_counter() - start, 3)
        print(f"{seconds[key]:8.3f} {key}", file=sys.stderr)
    total = round(sum(seconds.values()), 3)
    name = os.path.basename(sf_dir.rstrip("/"))
    print(json.dumps({"metric": "total query time", "value": total, "unit": "sec", "queries": seconds, "sf": name}))
    spark.stop()


if __name__ == "__main__":
    main()
