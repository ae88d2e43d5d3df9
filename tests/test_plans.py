"""Plan regressions: the physical properties the scale design relies on."""

import contextlib
import io

from conftest import SF_SMALL
from loadlens.plans.catalog import QUERIES


def plan(spark, name: str) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[name](spark, SF_SMALL).explain()
    return buf.getvalue()


def test_scan_prunes_columns_and_pushes_load_filters(spark):
    p = plan(spark, "house_slice_avg")
    assert "In(event_type, [click,purchase,view])" in p and "GreaterThan(value,0.0)" in p
    assert "props" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_head_selection_stays_hash_aggregate(spark):
    p = plan(spark, "house_state_prediction_as_run")
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p
    # partials by (key, pane), then by key; the replicated sum and the running window add none
    assert p.count("Exchange hashpartitioning") == 2


def test_parse_is_not_duplicated_into_scan_filters(spark):
    p = plan(spark, "parse_csv")
    assert "Generate inline(" in p
    assert "DataFilters: []" in p            # the validity check stays in the parse projection


def test_sliding_counts_replicate_partials_not_rows(spark):
    p = plan(spark, "sliding_event_count")
    gen = p.index("Generate explode(array(")
    assert "HashAggregate" in p[gen:]       # the partial aggregate sits below the replication of change points


def test_sliding_counts_of_a_hot_key_are_split_by_block(spark):
    import re

    p = re.sub(r"#\d+L?", "", plan(spark, "sliding_event_count"))
    # the running sum over panes is partitioned by key and block; only block totals are by key alone
    assert "windowspecdefinition(event_type, _b, pane ASC" in p
    assert "windowspecdefinition(event_type, pane ASC" not in p


def test_sliding_words_exchange_texts_not_counts(spark):
    import re

    p = re.sub(r"#\d+L?", "", plan(spark, "sliding_word_count"))
    assert p.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(_b, " in p
    p = re.sub(r"#\d+L?", "", plan(spark, "sliding_word_count_zeros"))
    # windows at zero come from one row per (word, block): no grid of words and panes is joined or exchanged
    assert "Join" not in p and p.count("Exchange hashpartitioning(word, ") == 1
    assert "windowspecdefinition(word, pane ASC" in p


def test_words_at_zero_are_dealt_like_the_texts(spark):
    import re

    # as many tasks whatever spark.sql.shuffle.partitions is: the words of a file stay few enough for a column's dictionary
    n = dict(re.findall(r"hashpartitioning\((_b|word), (\d+)\), REPARTITION_BY_NUM", re.sub(r"#\d+L?", "", plan(spark, "sliding_word_count_zeros"))))
    assert n["word"] == n["_b"] != spark.conf.get("spark.sql.shuffle.partitions")


def test_rolling_running_window_is_split_by_chunk(spark):
    import re

    p = re.sub(r"#\d+L?", "", plan(spark, "rolling_prediction"))
    assert "windowspecdefinition(house_id, _chunk, timestamp ASC" in p      # row level: per (house, chunk)
    assert "In(event_type, [click,purchase,view])" in p


def test_no_static_broadcast_on_estimates(spark):
    # the session broadcasts only after AQE measures a side: the initial plan has none
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert "BroadcastExchange" not in plan(spark, "house_error")


def test_cluster_conf_applies_to_a_session(spark):
    from loadlens.session import cluster_conf

    conf = cluster_conf(50 << 20, cores=4)
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert QUERIES["house_slice_avg"](spark, SF_SMALL).count() > 0
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_balanced_only_rebalances_underpartitioned_inputs(spark):
    from loadlens.sources.tables import balanced

    cores = spark.sparkContext.defaultParallelism
    one = spark.range(0, 1000, numPartitions=1)
    assert balanced(one).rdd.getNumPartitions() == cores
    many = spark.range(0, 1000, numPartitions=cores * 2)
    assert balanced(many) is many                      # enough partitions: no shuffle added
