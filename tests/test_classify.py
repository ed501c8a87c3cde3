from pyspark.sql import functions as F

from sensorlake.functions.classify import detect_anomalies, detect_window_patterns


def _classify(spark, rows):
    df = spark.createDataFrame(rows, "temperature_celsius double, temperature_fahrenheit double")
    return [(r.is_anomaly, r.anomaly_type) for r in detect_anomalies(df).collect()]


def test_celsius_thresholds_are_strict(spark):
    got = _classify(spark, [(40.0, 50.0), (40.01, 50.0), (-20.0, 50.0), (-20.01, 50.0)])
    assert got == [(False, "NORMAL"), (True, "HIGH_TEMP"), (False, "NORMAL"), (True, "LOW_TEMP")]


def test_fahrenheit_only_anomaly_is_typed_normal(spark):
    got = _classify(spark, [(30.0, 104.0), (30.0, 104.1), (0.0, -4.0), (0.0, -4.1)])
    assert got == [(False, "NORMAL"), (True, "NORMAL"), (False, "NORMAL"), (True, "NORMAL")]


def test_null_readings(spark):
    got = _classify(spark, [(None, 110.0), (None, None)])
    assert got == [(True, "NORMAL"), (False, "NORMAL")]


def test_usage_pattern_boundaries(spark):
    minutes = [4.99, 5.0, 29.99, 30.0, 119.99, 120.0, 300.0, 300.01, None]
    df = spark.createDataFrame([(m,) for m in minutes], "duration_minutes double")
    got = [(r.usage_pattern, r.is_unusual) for r in detect_window_patterns(df).collect()]
    assert got == [
        ("BRIEF_OPENING", False), ("SHORT_OPENING", False), ("SHORT_OPENING", False),
        ("MEDIUM_OPENING", False), ("MEDIUM_OPENING", False), ("LONG_OPENING", False),
        ("LONG_OPENING", False), ("LONG_OPENING", True), ("LONG_OPENING", False),
    ]


def test_classification_stays_in_codegen(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("temperature_celsius"),
                                F.col("id").cast("double").alias("temperature_fahrenheit"))
    plan = detect_anomalies(df)._jdf.queryExecution().executedPlan().toString()
    assert "WholeStageCodegen" in plan or "*(" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
