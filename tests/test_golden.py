"""Golden rows: the reference's published prediction blocks and its four word-count lines."""

import pytest

from loadlens.operators.averages import prediction_from_avg
from loadlens.operators.text import word_count
from loadlens.sources.text import literal_lines

# Fixed values: (key, avg, count, median, prediction) from the reference's output file.
GOLDEN = [
    ("10:0:5", 19.799999713897705, 2, 0.19799999713897706, 9.998999855518342),
    ("37:2:6", 1.8504999876022339, 2, 0.01850499987602234, 0.9345024937391281),
    ("11:1:3", 13.117499828338623, 2, 0.13117499828338625, 6.624337413311005),
    ("22:3:1", 1.125, 2, 0.01125, 0.568125),
    ("14:10:0", 1.6080000400543213, 4, 0.016080000400543214, 0.8120400202274323),
    ("4:4:0", 0.08049999922513962, 2, 8.049999922513962e-4, 0.040652499608695505),
    ("16:7:0", 1.8504999876022339, 2, 0.01850499987602234, 0.9345024937391281),
    ("32:6:3", 0.17749999463558197, 2, 0.0017749999463558196, 0.0896374972909689),
    ("24:1:1", 1.6080000400543213, 4, 0.016080000400543214, 0.8120400202274323),
    ("7:2:7", 1.6080000400543213, 2, 0.016080000400543214, 0.8120400202274323),
    ("4", 13.29424268938601, 144, 0.1329424268938601, 6.713592558139935),
    ("16", 7.30459570864292, 146, 0.0730459570864292, 3.6888208328646748),
    ("28", 6.461243106236866, 222, 0.06461243106236866, 3.262927768649617),
    ("32", 7.674427365155323, 138, 0.07674427365155323, 3.8755858194034385),
    ("36", 3.275628544815949, 70, 0.03275628544815949, 1.6541924151320542),
    ("0", 7.767781055811793, 160, 0.07767781055811793, 3.9227294331849554),
    ("24", 12.005675313440529, 74, 0.1200567531344053, 6.062866033287467),
    ("20", 10.06769114082798, 94, 0.1006769114082798, 5.08418402611813),
    ("12", 5.475021590357241, 46, 0.054750215903572416, 2.764885903130407),
    ("8", 18.021399484574793, 30, 0.18021399484574793, 9.10080673971027),
]

# The four literal lines of the batch word count.
LINES = [
    "To be, or not to be,--that is the question:--",
    "Whether 'tis nobler in the mind to suffer",
    "The slings and arrows of outrageous fortune",
    "Or to take arms against a sea of troubles,",
]


def test_golden_predictions(spark):
    df = spark.createDataFrame([(k, a, n) for k, a, n, _, _ in GOLDEN], "key string, avg_load double, n long")
    got = {r.key: (r.median, r.prediction) for r in prediction_from_avg(df).collect()}
    for k, _, _, m, p in GOLDEN:
        assert got[k][0] == pytest.approx(m, abs=1e-12)
        assert got[k][1] == pytest.approx(p, abs=1e-12)


def test_float_widening_is_kept(spark):
    from pyspark.sql import functions as F

    # a reading is parsed as a float and widened, so 19.8 arrives as 19.799999237060547
    v = spark.range(1).select(F.lit("19.8").cast("float").cast("double").alias("v")).first()["v"]
    assert v == 19.799999237060547


def test_literal_word_count(spark):
    got = {r.word: r.n for r in word_count(literal_lines(spark, LINES)).collect()}
    assert got["to"] == 4 and got["the"] == 3 and got["be"] == 2 and got["or"] == 2 and got["of"] == 2
    assert "" not in got
    assert sum(got.values()) == 34 and len(got) == 26
