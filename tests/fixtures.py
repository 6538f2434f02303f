"""Small inputs. Sensor readings are fixed values: the expected results hang on them."""

SENSOR_AVG = [
    ("sensor_1", t, 1547718199 + i)
    for i, t in enumerate(
        [25.5, 29.2, 22.4, 23.6, 25.1, 25.2, 35.7, 30.2, 28.5, 29.4, 27.5, 25.7, 28.8, 30.1, 26.4]
    )
]
SENSOR_STATE = [
    ("sensor_1", t, 1547718199 + i)
    for i, t in enumerate([25.2, 28.5, 12.2, 24.9, 25.2, 26.8, 27.2, 28.2, 29.2, 29.3, 29.5, 29.6])
]
SENSOR_INT = [
    ("sensor_1", 25, 1547718199), ("sensor_2", 26, 1547718199), ("sensor_3", 28, 1547718199),
    ("sensor_1", 29, 1547718200), ("sensor_1", 22, 1547718201), ("sensor_1", 23, 1547718202),
    ("sensor_1", 25, 1547718203), ("sensor_1", 25, 1547718204), ("sensor_1", 33, 1547718205),
    ("sensor_1", 30, 1547718206), ("sensor_1", 28, 1547718207), ("sensor_1", 29, 1547718208),
    ("sensor_1", 27, 1547718209), ("sensor_1", 25, 1547718230),
]
WORD_LINES = ["red kite", "red fox", "blue", "fox red fox", "kite over fox"]
NAMES = ["heron", "owl", "harrier", "hoopoe", "hen", "falcon", "starling"]


def sensors(spark, rows, kind="double"):
    """Readings with an arrival number and an event time."""
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, f"seq long, id string, temperature {kind}, ts_s long")
    return df.selectExpr("*", "timestamp_seconds(ts_s) AS ts")


def skewed(spark, rows=400, seed=7):
    """Rows of one dominant key, some small ones and a null key; values with ties and gaps in time."""
    import random

    rnd = random.Random(seed)
    data, ms = [], 1_700_000_000_000
    for seq in range(rows):
        ms += rnd.choice([0, 400, 1000, 1500, 7000])
        key = rnd.choice(["hot"] * 6 + ["a", "b", None])
        data.append((seq, key, float(rnd.choice([1, 2, 3, 5, 8, 13, 21, 30])), ms))
    df = spark.createDataFrame(data, "seq long, k string, v double, ms long")
    return df.selectExpr("*", "timestamp_millis(ms) AS ts")


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(x is None, str(type(x)), x or 0) for x in r])
