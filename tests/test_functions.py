"""Expression vectors for the UDF surface and scalar helpers (no I/O)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from airmart.functions import (aqi_band, aqi_criteria_met, boundary_diff, custom_aqi, day_name, day_of_week0,
                               defra_category, epa_category, format_location_name, freshness_status, hour_label,
                               is_valid_measurement, local_hour, mode_of, prominent_pollutant, round_avg,
                               surrogate_key)
from airmart.functions.names import LOWERCASE_WORDS


def py_format(name):
    """Brute-force restatement of the title-case rule used as the expected value."""
    if name is None:
        return None
    words = name.replace("_", " ").split()
    out = []
    for i, w in enumerate(words):
        out.append(w[:1].upper() + w[1:].lower() if i == 0 or w.lower() not in LOWERCASE_WORDS else w.lower())
    return " ".join(out)


def test_format_location_name(spark):
    names = ["santa_anita", "san_juan_de_lurigancho", "new_delhi", "villa_el_salvador", "de_la_cruz",
             "  a  b ", "", None, "LOS_OLIVOS", "magdalena_del_mar", "x"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.f for r in df.select("n", format_location_name("n").alias("f")).collect()}
    assert got["santa_anita"] == "Santa Anita"
    assert got["san_juan_de_lurigancho"] == "San Juan de Lurigancho"
    assert got["new_delhi"] == "New Delhi"
    assert got["villa_el_salvador"] == "Villa el Salvador"
    assert got["de_la_cruz"] == "De la Cruz"
    for n in names:
        assert got[n] == py_format(n), n


D = Decimal


def _pollutants(spark, rows):
    schema = ", ".join(f"{c} decimal(10,2)" for c in ("pm25", "pm10", "so2", "no2", "co", "o3"))
    df = spark.createDataFrame(rows, schema)
    cols = [F.col(c) for c in ("pm25", "pm10", "so2", "no2", "co", "o3")]
    return df.select(prominent_pollutant(*cols).alias("p"), aqi_criteria_met(*cols).alias("c"),
                     custom_aqi(*cols).alias("a"), is_valid_measurement(*cols).alias("v"),
                     aqi_criteria_met(*cols, arg_scale=0).alias("c0")).collect()


def test_pollutant_metrics(spark):
    rows = [
        (None, None, None, None, None, None),            # all NULL
        (D(0), D(0), D(0), D(0), D(0), D(0)),            # all zero
        (D(1), D(5), D(5), D(2), D(1), D(1)),            # tie PM10 / SO2 -> PM10
        (D(3), D(4), None, None, None, None),            # only PM
        (None, None, D(1), D(2), D(3), D("9.5")),        # only gases
        (D("0.4"), D("0.4"), D("0.4"), D("0.4"), D(0), D(0)),  # D3 fractional values
        (D(10), None, D(1), D(20), D(30), D(0)),         # criteria met
    ]
    r = _pollutants(spark, rows)
    assert [x.p for x in r] == ["PM2.5", "PM2.5", "PM10", "PM10", "O3", "PM2.5", "CO"]
    assert [x.c for x in r] == [0, 0, 3, 1, 2, 3, 3]
    assert [x.a for x in r] == [D(0), D(0), D(5), D(0), D(0), D("0.40"), D(30)]
    assert [x.v for x in r] == [False, False, True, False, False, True, True]
    # Arguments rounded to scale 0 first: 0.4 -> 0, so no criteria pollutant is positive.
    assert r[5].c0 == 0


def test_categories_bands_freshness(spark):
    df = spark.createDataFrame([(i,) for i in range(-1, 12)] + [(None,)], "i int")
    r = df.select("i", epa_category("i").alias("e"), defra_category("i").alias("d")).collect()
    epa = {x.i: x.e for x in r}
    dfr = {x.i: x.d for x in r}
    assert epa[0] == "Unknown" and epa[7] == "Unknown" and epa[None] == "Unknown"
    assert epa[3] == "Unhealthy for Sensitive Groups" and epa[6] == "Hazardous"
    assert dfr[3] == "Low" and dfr[4] == "Moderate" and dfr[9] == "High" and dfr[10] == "Very High"
    assert dfr[11] == "Unknown" and dfr[0] == "Unknown"
    bands = spark.createDataFrame([(50,), (51,), (100,), (150,), (151,), (None,)], "a int")
    assert [x.b for x in bands.select(aqi_band("a").alias("b")).collect()] == \
        ["green", "yellow", "yellow", "orange", "red", None]
    fr = spark.createDataFrame([(89,), (90,), (None,)], "m int").select(freshness_status("m").alias("s")).collect()
    assert [x.s for x in fr] == ["Fresh", "Stale", None]


def test_time_helpers(spark):
    rows = [(dt.datetime(2024, 1, 1, 4, 45), "Asia/Kolkata"),
            (dt.datetime(2024, 11, 3, 5, 30), "America/New_York"),
            (dt.datetime(2024, 11, 3, 6, 30), "America/New_York"),
            (dt.datetime(2024, 1, 7, 12, 0), "UTC")]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, tz string")
    r = df.select(local_hour("ts", "tz").alias("h"), day_of_week0("ts").alias("w"), day_name("ts").alias("n"),
                  hour_label(F.hour("ts")).alias("l")).collect()
    assert r[0].h == dt.datetime(2024, 1, 1, 10, 0)          # +05:30 half-hour zone
    assert r[1].h == r[2].h == dt.datetime(2024, 11, 3, 1, 0)  # DST fall-back: two UTC hours, one local hour
    assert r[3].w == 0 and r[3].n == "Sun"
    assert r[0].l == "04:00"
    d = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 59, 59), dt.datetime(2024, 1, 1, 11, 0, 0))],
                              "a timestamp_ntz, b timestamp_ntz")
    x = d.select(boundary_diff("MINUTE", "a", "b").alias("m"), boundary_diff("HOUR", "a", "b").alias("h")).first()
    assert x.m == 1 and x.h == 1  # boundaries crossed, although only one second elapsed


def test_surrogate_key_null_flags(spark):
    df = spark.createDataFrame([(None, 5), (5, None), (None, None)], "a int, b int")
    keys = [r.k for r in df.select(surrogate_key("a", "b").alias("k")).collect()]
    assert len(set(keys)) == 3 and all(k is not None for k in keys)


def test_round_avg_exact_for_large_groups(spark):
    # 50,000 x 0.01 and 50,001 x 0.00: the exact mean 0.0049999.. rounds to 0.00, while
    # avg() keeps six digits (0.005000) and a second rounding gives 0.01.
    df = spark.range(100001).select(F.when(F.col("id") < 50000, D("0.01")).otherwise(D("0.00"))
                                    .cast("decimal(10,2)").alias("x"))
    r = df.agg(round_avg("x", 2).alias("exact"), F.round(F.avg("x"), 2).alias("naive")).first()
    assert r.exact == D("0.00")
    assert r.naive == D("0.01")


def test_round_avg_half_up_and_empty(spark):
    df = spark.createDataFrame([(1, D("1.25")), (1, D("1.26")), (2, D("-1.25")), (2, D("-1.26")), (3, None)],
                               "g int, x decimal(10,2)")
    r = {x.g: x.a for x in df.groupBy("g").agg(round_avg("x", 1).alias("a")).collect()}
    assert r[1] == D("1.3")       # 1.255 -> 1.3 (half up)
    assert r[2] == D("-1.3")      # half away from zero
    assert r[3] is None


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert df.agg(mode_of("v").alias("m")).first().m == "a"


def test_cluster_settings_scale():
    from airmart.session import cluster_settings
    s = cluster_settings(100 << 40, executors=1000, cores_per_executor=8)
    assert int(s["spark.sql.shuffle.partitions"]) == 102400                     # one per GB of input
    small = cluster_settings(1 << 30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 120                    # never below 3x the slots


def test_name_and_column_paths_agree(spark):
    """The SQL-text fast path (column names) and the Column-API path build the same values."""
    rows = [(None, None, None, None, None, None, None, None),
            (D("0.4"), D("0.4"), D("0.4"), D("0.4"), D(0), D(0), 3, "san_juan_de_lurigancho"),
            (D(10), None, D(1), D(20), D(30), D(0), 10, "villa_el_salvador"),
            (D(1), D(5), D(5), D(2), D(1), D(1), 0, "  de la  PAZ ")]
    cols = ("pm25", "pm10", "so2", "no2", "co", "o3")
    df = spark.createDataFrame(rows, ", ".join(f"{c} decimal(10,2)" for c in cols) + ", i int, n string")
    c = [F.col(x) for x in cols]
    pairs = [(prominent_pollutant(*cols), prominent_pollutant(*c)),
             (aqi_criteria_met(*cols), aqi_criteria_met(*c)),
             (aqi_criteria_met(*cols, arg_scale=0), aqi_criteria_met(*c, arg_scale=0)),
             (custom_aqi(*cols), custom_aqi(*c)),
             (is_valid_measurement(*cols), is_valid_measurement(*c)),
             (epa_category("i"), epa_category(F.col("i"))), (defra_category("i"), defra_category(F.col("i"))),
             (aqi_band("i"), aqi_band(F.col("i"))), (format_location_name("n"), format_location_name(F.col("n")))]
    out = df.select(*[a.alias(f"a{k}") for k, (a, _) in enumerate(pairs)],
                    *[b.alias(f"b{k}") for k, (_, b) in enumerate(pairs)]).collect()
    for r in out:
        for k in range(len(pairs)):
            assert r[f"a{k}"] == r[f"b{k}"], (k, r)
    agg = df.agg(round_avg("pm25", 1).alias("a"), round_avg(F.col("pm25"), 1).alias("b")).first()
    assert agg.a == agg.b
