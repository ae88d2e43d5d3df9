"""Independent DuckDB SQL for each registered query (the correctness oracle).

Written straight from the semantics (row expansion, ASOF JOIN, list
functions), not from the Spark plans, so the two sides check each other.
Tables ``events`` and ``documents`` are views over the driver's parquet.
"""

from __future__ import annotations

from loadlens.plans.catalog import (CUT_ID, CUT_SLICES, DOCS_PER_LONG_PANE, DOCS_PER_PANE, EVENT_SLIDE, EVENT_WINDOW, FIRST, K,
                                    PANE, SHORT_PANE, SLICES, TF, TUMBLE_SECONDS, WIDE_PANES, WORD_PANES)

HOUSE = ("house_id",)
PLUG = ("house_id", "household_id", "plug_id")

M = """m AS (
  SELECT event_id AS id,
         CAST(floor(epoch(ts)) AS INTEGER) AS "timestamp",
         CAST(value AS FLOAT) AS value,
         CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 1 ELSE 0 END AS property,
         CAST(user_id % 5 AS INTEGER) AS plug_id,
         CAST((user_id % 15) // 5 AS INTEGER) AS household_id,
         CAST(user_id // 15 AS INTEGER) AS house_id,
         concat_ws(':', CAST(user_id // 15 AS INTEGER), CAST((user_id % 15) // 5 AS INTEGER),
                   CAST(user_id % 5 AS INTEGER)) AS hhp_id
  FROM events)"""
V = "v AS (SELECT * FROM m WHERE property = 1 AND value > 0 AND NOT isnan(value))"
ROW_COLS = 'id, "timestamp", CAST(value AS DOUBLE) AS value, property, plug_id, household_id, house_id, hhp_id'


def r6(x: str) -> str:
    """Round half-up on the shortest decimal form, as Spark's ``round`` does for doubles."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), 6) AS DOUBLE)"


def sl(c: str, tf: int) -> str:
    r = f"(CAST({c} AS BIGINT) - 1377986401)"
    return (f"CAST(CASE WHEN {r} // 86400 > 0 THEN {r} // {tf} - ({r} // 86400) * {86400 // tf} "
            f"ELSE {r} // {tf} END AS INTEGER)")


def shifted(arr: str) -> str:
    n = f"len({arr})"
    return (f"coalesce(CASE WHEN {n} % 2 = 0 THEN ({arr}[{n} // 2 + 1] + {arr}[{n} // 2 + 2]) / 2 "
            f"ELSE {arr}[({n} + 1) // 2 + 1] END, 0.0)")


def _k(keys) -> str:
    return ", ".join(keys)


def _on(a: str, b: str, cols) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in cols)


def prep(keys, base: str = "v", pane: int = PANE) -> str:
    return (f"p AS (SELECT {_k(keys)}, id, \"timestamp\", CAST(value AS DOUBLE) AS v, "
            f"{sl('timestamp', TF)} AS s, CAST(\"timestamp\" AS BIGINT) // {pane} AS p0 FROM {base})")


def history(keys) -> str:
    ks = _k(keys)
    return f""",
d AS (SELECT {ks}, s, v, min(p0) AS fp FROM p GROUP BY {ks}, s, v),
pp AS (SELECT {ks}, s, fp, sum(v) AS ds, count(*) AS dc FROM d GROUP BY {ks}, s, fp),
h AS (SELECT {ks}, s, fp, {r6('sum(ds) OVER w / sum(dc) OVER w')} AS avg_load FROM pp
      WINDOW w AS (PARTITION BY {ks}, s ORDER BY fp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
fa AS (SELECT {ks}, s, avg_load, min(fp) AS fp FROM h GROUP BY {ks}, s, avg_load),
mh AS (SELECT {ks}, s, fp, list_sort(list(avg_load) OVER (PARTITION BY {ks}, s ORDER BY fp
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS arr FROM fa),
mhm AS (SELECT {ks}, s, fp, {shifted('arr')} AS median FROM mh)"""


def base(keys, pane: int = PANE) -> str:
    return f"WITH {M},\n{V},\n{prep(keys, pane=pane)}{history(keys)}"


def state(keys, source: str, pane: int = PANE) -> str:
    """CTE chain for one level: ``pred`` (predictions), ``pset`` (their set), ``pmin`` (its minimum), not rounded."""
    ks = _k(keys)
    med = "hv" if source == "as_run" else "coalesce(mhm.median, st.hv)"
    join = "" if source == "as_run" else (
        f"ASOF LEFT JOIN mhm ON {_on('st', 'mhm', keys)} AND st.s = mhm.s AND st.pane >= mhm.fp")
    sel = ", ".join(f"st.{c}" for c in keys)
    return base(keys, pane) + f""",
x AS (SELECT {ks}, id, "timestamp", v, s, unnest(generate_series(p0, p0 + {K - 1})) AS pane FROM p),
win AS (SELECT {ks}, pane, sum(v) AS wsum, count(*) AS wcnt,
        min(struct_pack(t := "timestamp", i := id, v := v, s := s)) AS head FROM x GROUP BY {ks}, pane),
st AS (SELECT {ks}, pane, sum(wsum) OVER w AS total, CAST(sum(wcnt) OVER w AS BIGINT) AS n,
       head.t AS head_timestamp, head.v AS hv, head.s AS s FROM win
       WINDOW w AS (PARTITION BY {ks} ORDER BY pane ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
sm AS (SELECT {sel}, st.pane, st.head_timestamp, st.n, st.total, st.s, {med} AS med FROM st {join}),
pred AS (SELECT {ks}, pane, head_timestamp, n, (total / n + med) / 2 AS predicted_load,
         s + 1 AS target_slice FROM sm),
pset AS (SELECT DISTINCT {TF} AS tf, target_slice, {ks}, predicted_load FROM pred),
pmin AS (SELECT target_slice, {ks}, min(predicted_load) AS predicted_load FROM pset GROUP BY target_slice, {ks})"""


def error(keys, shift: int) -> str:
    ks = _k(keys)
    return state(keys, "intended") + f""",
a AS (SELECT {ks}, s AS slice, avg(v) AS avg_load FROM p GROUP BY {ks}, s)
SELECT {", ".join("a." + c for c in keys)}, a.slice, {r6('pmin.predicted_load')} AS predicted_load, {r6('a.avg_load')} AS avg_load,
       {r6('abs(pmin.predicted_load - a.avg_load)')} AS error
FROM a JOIN pmin ON {_on('a', 'pmin', keys)} AND pmin.target_slice = a.slice + {shift}"""


def with_median(keys, source: str, pane: int = PANE) -> str:
    ks = _k(keys)
    rows = f"""rows AS (SELECT {ks}, id, "timestamp", s, v, unnest(generate_series(p0, p0 + {K - 1})) AS pane FROM p)"""
    if source == "as_run":
        return base(keys) + f""",
{rows}
SELECT {ks}, id, "timestamp", s AS slice, pane, {r6('v')} AS value, {r6('v')} AS median FROM rows"""
    sel = ", ".join(f"rows.{c}" for c in keys)
    return base(keys, pane) + f""",
{rows}
SELECT {sel}, rows.id, rows."timestamp", rows.s AS slice, rows.pane, {r6('rows.v')} AS value,
       {r6('coalesce(mhm.median, rows.v)')} AS median
FROM rows ASOF LEFT JOIN mhm ON {_on('rows', 'mhm', keys)} AND rows.s = mhm.s AND rows.pane >= mhm.fp"""


def java_split_sql(s: str, pattern: str, all_match: str) -> str:
    """JVM ``split``: drop trailing empties, ``'' -> ['']``, all-separator -> []."""
    return (f"CASE WHEN {s} = '' THEN [''] WHEN regexp_full_match({s}, '{all_match}') THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array(regexp_replace({s}, '{pattern}$', ''), '{pattern}') END")


def level_sql(keys) -> dict[str, str]:
    ks = _k(keys)
    lvl = "house" if len(keys) == 1 else "plug"
    hhp = ", concat_ws(':', house_id, household_id, plug_id) AS hhp_id" if len(keys) == 3 else ""
    out = {
        f"{lvl}_slice_avg": f"WITH {M},\n{V},\n{prep(keys)}\n"
                            f"SELECT {ks}, s AS slice, count(*) AS n, {r6('avg(v)')} AS avg_load FROM p GROUP BY {ks}, s",
        f"{lvl}_distinct_avg": f"WITH {M},\n{V},\n{prep(keys)}\n"
                               f"SELECT {ks}, s AS slice, count(*) AS n_distinct, {r6('avg(v)')} AS avg_load "
                               f"FROM (SELECT DISTINCT {ks}, s, v FROM p) GROUP BY {ks}, s",
        f"{lvl}_measure": f"WITH {M},\n{V},\n{prep(keys)}\n"
                          f"SELECT {TF} AS tf, s AS slice, {ks}, {r6('v')} AS value FROM (SELECT DISTINCT {ks}, s, v FROM p)",
        f"{lvl}_averages": base(keys) + f"\nSELECT DISTINCT {TF} AS tf, s AS slice, {ks}, avg_load FROM h",
        f"{lvl}_overall_avg": f"WITH {M},\n{V}\nSELECT {ks}, {r6('avg(CAST(value AS DOUBLE))')} AS avg_load, "
                              f"count(*) AS n{hhp} FROM v GROUP BY {ks}",
        f"{lvl}_overall_prediction": f"WITH {M},\n{V},\no AS (SELECT {ks}, avg(CAST(value AS DOUBLE)) AS a, count(*) AS n "
                                     f"FROM v GROUP BY {ks})\nSELECT {ks}, {r6('a')} AS avg_load, n{hhp}, "
                                     f"{r6('a * CAST(0.01 AS DOUBLE)')} AS median, "
                                     f"{r6('(a + a * CAST(0.01 AS DOUBLE)) / 2')} AS prediction FROM o",
        f"{lvl}_median_ref": base(keys) + f",\nf AS (SELECT {ks}, s, list_sort(list(DISTINCT avg_load)) AS arr FROM h "
                            f"GROUP BY {ks}, s)\nSELECT {ks}, s AS slice, len(arr) AS n, {r6(shifted('arr'))} AS median FROM f",
        f"{lvl}_median_exact": base(keys) + f"\nSELECT {ks}, s AS slice, count(*) AS n, {r6('median(avg_load)')} AS median "
                              f"FROM (SELECT DISTINCT {ks}, s, avg_load FROM h) GROUP BY {ks}, s",
        f"{lvl}_with_median": with_median(keys, "intended"),
        f"{lvl}_with_median_as_run": with_median(keys, "as_run"),
        f"{lvl}_state_prediction": state(keys, "intended") + f"\n{ROUNDED} FROM pred",
        f"{lvl}_state_prediction_short": state(keys, "intended", SHORT_PANE) + f"\n{ROUNDED} FROM pred",
        f"{lvl}_with_median_short": with_median(keys, "intended", SHORT_PANE),
        f"{lvl}_state_prediction_as_run": state(keys, "as_run") + f"\n{ROUNDED} FROM pred",
        f"{lvl}_prediction": state(keys, "intended") + f"\n{ROUNDED} FROM pset",
        f"{lvl}_prediction_min": state(keys, "intended") + f"\n{ROUNDED} FROM pmin",
        f"{lvl}_error": error(keys, 1),
        f"{lvl}_median_measures": (f"WITH {M},\n{V},\n{prep(keys)},\nf AS (SELECT {ks}, s, list_sort(list(DISTINCT v)) AS arr "
                                   f"FROM p GROUP BY {ks}, s)\nSELECT {ks}, s AS slice, len(arr) AS n, "
                                   f"{r6(shifted('arr'))} AS median FROM f"),
        f"{lvl}_measure_card": (f"WITH {M},\n{V},\n{prep(keys)}\nSELECT {ks}, s AS slice, count(DISTINCT v) AS card "
                                f"FROM p GROUP BY {ks}, s"),
        f"{lvl}_measure_sorted": (f"WITH {M},\n{V},\n{prep(keys)}\nSELECT {ks}, s AS slice, "
                                  f"row_number() OVER (PARTITION BY {ks}, s ORDER BY v) - 1 AS rank, "
                                  f"{r6('v')} AS value FROM (SELECT DISTINCT {ks}, s, v FROM p)"),
    }
    out[f"{lvl}_measure_first"] = f"SELECT * FROM ({out[f'{lvl}_measure_sorted']}) WHERE rank < {FIRST}"
    return out


ROUNDED = f"SELECT * REPLACE ({r6('predicted_load')} AS predicted_load)"


def _text_sql() -> dict[str, str]:
    wc = (f"WITH t AS (SELECT lower(text) AS s FROM documents),\n"
          f"tok AS (SELECT unnest({java_split_sql('s', chr(92) + 'W+', chr(92) + 'W+')}) AS word FROM t)\n")
    lines = "regexp_split_to_array(regexp_replace(text, '(\\r\\n|\\n|\\r)\\z', ''), '\\r\\n|\\n|\\r')"

    def windows(docs: int) -> str:
        return (f"WITH tok AS (SELECT doc_id, unnest({java_split_sql('text', ' ', ' +')}) AS word FROM documents),\n"
                f"panes AS (SELECT unnest(generate_series((SELECT min(doc_id) FROM tok) // {docs}, "
                f"(SELECT max(doc_id) FROM tok) // {docs} + {WORD_PANES - 1})) AS pane),\n"
                f"c AS (SELECT word, pane, count(*) AS n FROM tok JOIN panes ON doc_id >= (pane - {WORD_PANES - 1}) * {docs} "
                f"AND doc_id < (pane + 1) * {docs} GROUP BY word, pane)\n")

    return {
        "word_count": wc + "SELECT word, count(*) AS n FROM tok GROUP BY word",
        "word_count_nonempty": wc + "SELECT word, count(*) AS n FROM tok WHERE word <> '' GROUP BY word",
        "line_contains_counts": (
            f"SELECT CAST(sum(len(list_filter(ls, lambda x: contains(x, 'a')))) AS BIGINT) AS lines_with_a, "
            f"CAST(sum(len(list_filter(ls, lambda x: contains(x, 'b')))) AS BIGINT) AS lines_with_b "
            f"FROM (SELECT {lines} AS ls FROM documents)"),
        "sliding_word_count": windows(DOCS_PER_PANE) + "SELECT word, pane, n FROM c",
        "sliding_word_count_zeros": windows(DOCS_PER_LONG_PANE) + (
            f", seen AS (SELECT word, min(doc_id) AS first_doc FROM tok GROUP BY word)\n"
            f"SELECT seen.word, panes.pane, coalesce(n, 0) AS n FROM seen "
            f"JOIN panes ON panes.pane >= first_doc // {DOCS_PER_LONG_PANE} "
            f"LEFT JOIN c ON c.word = seen.word AND c.pane = panes.pane"),
    }


def rolling(avg: str) -> str:
    """(avg + copySign(avg * 0.01, prior sum)) / 2 over the running sum and count."""
    pred = "(a + CASE WHEN prior < 0 THEN -abs(a * CAST(0.01 AS DOUBLE)) ELSE abs(a * CAST(0.01 AS DOUBLE)) END) / 2"
    return (
        f"WITH {M},\nr AS (SELECT house_id, household_id, id, \"timestamp\", CAST(value AS DOUBLE) AS v "
        f"FROM m WHERE property = 1),\n"
        f"s AS (SELECT *, sum(v) OVER w AS tot, count(*) OVER w AS c, coalesce(sum(v) OVER (PARTITION BY house_id "
        f"ORDER BY \"timestamp\", id, v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS prior FROM r "
        f"WINDOW w AS (PARTITION BY house_id ORDER BY \"timestamp\", id, v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))\n"
        f"SELECT house_id, household_id, id, \"timestamp\", {r6(pred)} AS predicted_load FROM (SELECT *, {avg} AS a FROM s)")


def event_counts(panes: int) -> str:
    """Raw events joined to the windows that hold them."""
    return (
        f"WITH r AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events),\n"
        f"panes AS (SELECT unnest(generate_series((SELECT min(t) FROM r) // {EVENT_SLIDE}, "
        f"(SELECT max(t) FROM r) // {EVENT_SLIDE} + {panes - 1})) AS pane)\n"
        f"SELECT event_type, pane, (pane - {panes - 1}) * {EVENT_SLIDE} AS window_start, "
        f"(pane + 1) * {EVENT_SLIDE} AS window_end, count(*) AS n FROM r JOIN panes "
        f"ON t >= (pane - {panes - 1}) * {EVENT_SLIDE} AND t < (pane + 1) * {EVENT_SLIDE} GROUP BY event_type, pane")


def faulty(select: str) -> str:
    """Rows of ``m`` with their wire fields as text and the kind of fault (by id)."""
    return (f"WITH {M},\nw AS (SELECT *, id % 8 AS kind, concat_ws(',', id, \"timestamp\") AS head, CAST(value AS VARCHAR) AS val, "
            f"concat_ws(',', property, plug_id, household_id) AS mid, house_id AS tail FROM m)\n{select}")


def _misc_sql() -> dict[str, str]:
    hp = prep(HOUSE)
    return {
        "valid_measurements": f"WITH {M},\n{V}\nSELECT {ROW_COLS} FROM v",
        "load_measurements": f"WITH {M}\nSELECT {ROW_COLS} FROM m WHERE property = 1",
        "household_filter": f"WITH {M}\nSELECT {ROW_COLS} FROM m WHERE household_id = 0",
        "domain_bounds": (f"WITH {M}\nSELECT {ROW_COLS} FROM m WHERE house_id BETWEEN 0 AND 40 "
                          f"AND household_id BETWEEN 0 AND 40 AND plug_id BETWEEN 0 AND 40"),
        "plug_measurements": (f"WITH {M},\n{V}\nSELECT house_id, household_id, plug_id, \"timestamp\", "
                              f"{r6('CAST(value AS DOUBLE)')} AS value, 0.0::DOUBLE AS median, hhp_id FROM v"),
        "house_measurements": (f"WITH {M},\n{V}\nSELECT house_id, \"timestamp\", {r6('CAST(value AS DOUBLE)')} AS value, "
                               f"0.0::DOUBLE AS median, hhp_id FROM v"),
        "house_value_pairs": f"WITH {M}\nSELECT house_id, {r6('CAST(value AS DOUBLE)')} AS value FROM m",
        "plug_value_pairs": f"WITH {M}\nSELECT hhp_id, {r6('CAST(value AS DOUBLE)')} AS value FROM m WHERE property = 1",
        "time_slice": (f"WITH {M}\nSELECT id, \"timestamp\", "
                       + ", ".join(f"{sl('timestamp', t)} AS slice_{t}" for t in SLICES) + " FROM m"),
        "encode_csv": (f"WITH {M}\nSELECT CAST(NULL AS VARCHAR) AS key, concat_ws(',', id, \"timestamp\", "
                       f"CAST(value AS VARCHAR), property, plug_id, household_id, house_id) AS value FROM m"),
        "parse_csv": f"WITH {M}\nSELECT {ROW_COLS} FROM m",
        "parse_csv_faulty": faulty(
            f"SELECT {ROW_COLS} FROM (SELECT * REPLACE (CASE WHEN kind = 3 THEN 10 ELSE value END AS value) FROM w "
            f"WHERE kind IN (0, 3, 5, 7))"),
        "parse_csv_rejects": faulty(
            "SELECT CASE kind WHEN 1 THEN concat_ws(',', head, val, mid) WHEN 2 THEN concat_ws(',', head, 'inf', mid, tail) "
            "WHEN 4 THEN '99999999999999999999' || concat_ws(',', head, val, mid, tail) "
            "ELSE concat_ws(',', id || ' ', \"timestamp\", val, mid, tail) END AS line FROM w WHERE kind IN (1, 2, 4, 6)"),
        "domain_bounds_cut": (f"WITH {M}\nSELECT {ROW_COLS}, {sl('timestamp', TF)} AS slice_{TF} FROM m "
                              f"WHERE house_id <= {CUT_ID} AND household_id <= {CUT_ID} AND plug_id <= {CUT_ID} "
                              f"AND {sl('timestamp', TF)} BETWEEN {CUT_SLICES[0]} AND {CUT_SLICES[1]}"),
        "parse_regex": f"WITH {M}\nSELECT {ROW_COLS} FROM m",
        "union_sources": f"WITH {M}\nSELECT {ROW_COLS} FROM m UNION ALL SELECT {ROW_COLS} FROM m",
        "house_error_target": error(HOUSE, 0),
        "sliding_panes": (f"WITH {M},\n{V},\n{hp},\npanes AS (SELECT unnest(generate_series((SELECT min(p0) FROM p), "
                          f"(SELECT max(p0) FROM p) + {K - 1})) AS pane)\n"
                          f"SELECT house_id, pane, (pane - {K - 1}) * {PANE} AS window_start, (pane + 1) * {PANE} AS window_end, "
                          f"count(*) AS n, {r6('sum(v)')} AS sum_load FROM p JOIN panes ON \"timestamp\" >= (pane - {K - 1}) * {PANE} "
                          f"AND \"timestamp\" < (pane + 1) * {PANE} GROUP BY house_id, pane"),
        "batch_counts": (f"WITH {M},\nc AS (SELECT CAST(\"timestamp\" AS BIGINT) // {PANE} AS pane, count(*) AS n "
                         f"FROM m GROUP BY 1)\nSELECT pane, n, CAST(sum(n) OVER (ORDER BY pane ROWS BETWEEN "
                         f"UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total FROM c"),
        "tumbling_house_sum": (f"WITH {M}\nSELECT house_id, CAST(\"timestamp\" AS BIGINT) // {TUMBLE_SECONDS} * "
                               f"{TUMBLE_SECONDS} AS window_start, count(*) AS n, "
                               f"{r6('sum(CAST(value AS DOUBLE))')} AS sum_value FROM m GROUP BY 1, 2"),
        "rolling_prediction": rolling("tot / c"),
        "rolling_prediction_float": rolling("CAST(CAST(tot / c AS FLOAT) AS DOUBLE)"),
        "sliding_event_count": event_counts(EVENT_WINDOW // EVENT_SLIDE),
        "sliding_event_count_wide": event_counts(WIDE_PANES),
    }


def oracle_queries() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(level_sql(HOUSE))
    out.update(level_sql(PLUG))
    out.update(_text_sql())
    out.update(_misc_sql())
    # streaming forms must equal their batch forms
    out["stream_sliding_event_count"] = out["sliding_event_count"]
    out["stream_house_slice_avg"] = out["house_slice_avg"]
    out["stream_tumbling_house_sum"] = out["tumbling_house_sum"]
    for name in ("house_measure", "plug_measure", "house_averages", "plug_averages"):
        out[f"stream_{name}"] = out[name]
    out["stream_word_count"] = out["word_count_nonempty"]
    out["stream_house_state_prediction_as_run"] = state(HOUSE, "as_run") + f"\n{ROUNDED} FROM pred"
    out["stream_plug_state_prediction_as_run"] = state(PLUG, "as_run") + f"\n{ROUNDED} FROM pred"
    for name in ("house_state_prediction", "plug_state_prediction", "house_prediction", "plug_prediction",
                 "sliding_event_count_wide"):
        out[f"stream_{name}"] = out[name]
    out["stream_house_error"] = out["house_error"]
    for level in ("house", "plug"):
        out[f"stream_{level}_averages_delta"] = out[f"{level}_averages"]
    out["stream_rolling_prediction"] = out["rolling_prediction_float"]
    return out
