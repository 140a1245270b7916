from pyspark.sql import functions as F

from wxspark.operators import metrics


def scores(spark, rows):
    df = spark.createDataFrame(rows, "y int, p double")
    return df.agg(metrics.accuracy(F.col("y"), F.col("p")), metrics.precision(F.col("y"), F.col("p"))).first()


def test_classification(spark):
    assert tuple(scores(spark, [(1, 1.0), (0, 1.0), (0, 0.0), (1, 0.0), (1, 1.0)])) == (0.6, 2 / 3)


def test_precision_without_positives_is_zero(spark):
    assert tuple(scores(spark, [(1, 0.0), (0, 0.0)])) == (0.5, 0.0)


def test_mean_absolute_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (5.0, 2.0)], "y double, p double")
    assert df.agg(metrics.mean_absolute_error(F.col("y"), F.col("p"))).first()[0] == 2.0


def test_row_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert {(r.k, r.n_rows) for r in metrics.row_counts(df, "k").collect()} == {("a", 2), (None, 1), ("All Data", 3)}


def test_rows(spark):
    df = spark.createDataFrame([(0.5, 2.0)], "a__accuracy double, b__mae double")
    rows = metrics.as_rows(df, df.columns).collect()
    assert [tuple(r) for r in rows] == [("a", "accuracy", 0.5), ("b", "mae", 2.0)]


def test_shown(spark):
    rows = [
        ("extreme", "accuracy", 0.89312),
        ("temp_celsius", "mae", 9.56789),
        ("humidity_percent", "mae", 15.0),
        ("wind_speed_kmh", "mae", 7.5),
    ]
    shown = metrics.display_metrics(spark.createDataFrame(rows, "model string, metric string, value double"))
    assert {r.model: (r.headline, r.detail) for r in shown.collect()} == {
        "extreme": ("89.3%", None),
        "temp_celsius": ("9.57°C", "9.5679"),
        "humidity_percent": ("15.00%", None),
        "wind_speed_kmh": (None, "7.5000"),
    }
