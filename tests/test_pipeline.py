"""End to end on the smallest driver tables: entry, a few registered
queries against their DuckDB oracles, streaming restart, golden-style
properties."""
import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from laborlens.plans import registry
from laborlens.sources.tables import TABLES
from scripts.compare import differences


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["area_normalized", "count", "mean", "median", "std", "min", "max"]


def test_every_query_has_a_known_prefix():
    ids = {n.split("_")[0] for n in E.queries()}
    assert all(i[0] in "spcjauwtmbvs" or i.startswith("op") for i in ids)
    assert set(E.oracle_sql()) <= set(E.queries())


def _duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    """Every query that has SQL, at the precision that it states."""
    sdf = registry.queries()[name](spark, SF_SMALL)
    res = _duck().execute(registry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert differences(sdf.columns, [tuple(r) for r in sdf.collect()], ocols, res.fetchall()) == []


def test_comparison_sees_the_last_stated_place():
    rows = [("a", 0.190401, 5, None, True), ("b", 4.0, 7, 1e12, False)]
    cols = ["g", "p", "n", "x", "f"]
    assert differences(cols, rows, cols, list(reversed(rows))) == []
    for i, j, v in ((0, 1, 0.190402), (0, 1, 0.1904011), (1, 2, 8), (1, 3, 1e12 + 2000), (0, 3, 0.0), (1, 4, True), (0, 0, "c")):
        other = [list(r) for r in rows]
        other[i][j] = v
        assert len(differences(cols, rows, cols, other)) >= 1
    assert differences(cols, rows, cols, rows[:1]) and differences(cols, rows, cols[:4] + ["z"], rows)


def test_pairwise_differences_are_transitive(spark):
    rows = {(r.group_1, r.group_2): r.mean_diff for r in E.queries()["t04_pairwise_ttests"](spark, SF_SMALL).collect()}
    assert abs(rows[("Almaty", "Other")] - (rows[("Almaty", "Astana")] + rows[("Astana", "Other")])) < 0.05


def test_rules_share_lift_both_ways(spark):
    rules = E.queries()["m17_association_rules"](spark, SF_SMALL).collect()
    lift = {(r.antecedents, r.consequents): r.lift for r in rules}
    for (a, c), v in lift.items():
        if (c, a) in lift:
            assert abs(lift[(c, a)] - v) < 1e-6
    assert all(r.confidence >= 0.5 for r in rules)


def test_streaming_restart_and_many_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from laborlens.plans.q_io import _EVENT_SCHEMA
    from laborlens.streaming.landing import land_stream, read_landed

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    in_dir, out_dir, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    ev.repartition(3).write.json(in_dir)
    land_stream(spark, in_dir, out_dir, ck, _EVENT_SCHEMA, "event_id", "ts")
    first = read_landed(spark, out_dir).count()
    # more files with repeats, then restart from the same checkpoint
    ev.repartition(2).write.mode("append").json(in_dir)
    land_stream(spark, in_dir, out_dir, ck, _EVENT_SCHEMA, "event_id", "ts", max_files_per_trigger=1)
    out = read_landed(spark, out_dir)
    assert first == ev.count() == out.count() == out.select("event_id").distinct().count()


def test_streaming_loses_no_late_id(spark, tmp_path):
    """Ids that come years late, out of order and again are landed once."""
    from pyspark.sql import types as T

    from laborlens.streaming.landing import land_stream, read_landed

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.StringType()), T.StructField("v", T.StringType())])
    in_dir, out_dir, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for batch in ([(1, "2024-01-02T00:00:00", "a"), (1, "2024-01-01T00:00:00", "old"), (9, "2024-03-01T00:00:00", "b")],
                  [(3, "2010-01-01T00:00:00", "c"), (9, "2030-01-01T00:00:00", "again")], [(5, "1999-01-01T00:00:00", "d"), (None, None, "n")], []):
        spark.createDataFrame(batch, schema).write.mode("append").json(in_dir)
        land_stream(spark, in_dir, out_dir, ck, schema, "id", "ts")
    got = {(r.id, r.v) for r in read_landed(spark, out_dir).collect()}
    assert got == {(1, "a"), (9, "b"), (3, "c"), (5, "d"), (None, "n")}


def test_streaming_lands_every_row_without_a_key(spark, tmp_path):
    """In one batch and in later ones, beside keys that are landed once."""
    from pyspark.sql import types as T

    from laborlens.streaming.landing import land_stream, read_landed

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.StringType()), T.StructField("v", T.StringType())])
    in_dir, out_dir, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for batch in ([(None, None, "a"), (None, "2024-01-01T00:00:00", "b"), (1, None, "c")], [(None, None, "d"), (None, None, "e"), (1, None, "again")]):
        spark.createDataFrame(batch, schema).write.mode("append").json(in_dir)
        land_stream(spark, in_dir, out_dir, ck, schema, "id", "ts")
    got = sorted((r.id or 0, r.v) for r in read_landed(spark, out_dir).collect())
    assert got == [(0, "a"), (0, "b"), (0, "d"), (0, "e"), (1, "c")]
