"""Scalar and text functions on tiny literal frames, with the edge rows of
the fixtures: nulls, band edges, labels such as ci/cd, c#, 1с."""
from pyspark.sql import functions as F

from laborlens import constants as K
from laborlens.functions import scalar as S
from laborlens.functions import text as T


def test_range_midpoint_and_currency(spark):
    df = spark.createDataFrame(
        [(100.0, 200.0, "USD"), (100.0, None, "eur"), (None, 50.0, "RUR"), (None, None, "USD"), (10.0, 20.0, None),
         (10.0, 20.0, "KZT"), (10.0, 20.0, "xusdx")],
        "lo double, hi double, cur string")
    got = [r[0] for r in df.select(S.to_base_currency(S.range_midpoint("lo", "hi"), "cur")).collect()]
    assert got == [150.0 * 480, 100.0 * 520, 50.0 * 5.2, None, 15.0, 15.0, 15.0 * 480]


def test_city_normalisation(spark):
    df = spark.createDataFrame([("г. Алматы",), ("Nur-Sultan",), ("Шымкент",), (None,), ("Караганда",), ("Paris",)], "a string")
    got = [r[0] for r in df.select(S.normalize_category("a")).collect()]
    assert got == ["Almaty", "Astana", "Shymkent", "Other", "Karaganda", "Other"]


def test_ordinal_round_trip(spark):
    df = spark.createDataFrame([("Нет опыта",), ("Более 6 лет",), ("unknown",), (None,)], "e string")
    got = [tuple(r) for r in df.select(S.encode_ordinal("e").alias("l")).select("l", S.decode_ordinal("l")).collect()]
    assert got == [(0, "No Experience"), (3, "6+ years"), (0, "No Experience"), (0, "No Experience")]


def test_title_label_matches_str_title(spark):
    labels = ["skill_ci/cd", "skill_1с_программирование", "skill_c#", "skill_rest_api", "skill_gitlab_ci"]
    df = spark.createDataFrame([(x,) for x in labels], "s string")
    got = [r[0] for r in df.select(S.title_label("s")).collect()]
    assert got == [x.replace("skill_", "").replace("_", " ").title() for x in labels]


def test_slug(spark):
    df = spark.createDataFrame([("Vue.js",), ("GitLab CI",), ("CI/CD",)], "s string")
    assert [r[0] for r in df.select(S.slug("s")).collect()] == ["vuejs", "gitlab_ci", "ci/cd"]


def test_bands_on_edges(spark):
    df = spark.createDataFrame([(-0.1,), (0.0,), (10.0,), (19.99,), (20.0,), (None,)], "g double")
    got = [r[0] for r in df.select(S.band("g", *K.GAP_BANDS)).collect()]
    assert got == ["EXCELLENT", "GOOD", "MEDIUM", "MEDIUM", "HIGH", None]
    pdf = spark.createDataFrame([(99999.0,), (100000.0,), (200000.0,)], "p double")
    assert [r[0] for r in pdf.select(S.band("p", *K.PREMIUM_BANDS)).collect()] == ["standard", "high", "top"]


def test_cap_keeps_null(spark):
    df = spark.createDataFrame([(None,), (5.0,), (50.0,)], "x double")
    got = [r[0] for r in df.select(S.cap("x", F.lit(0.0), F.lit(10.0))).collect()]
    assert got == [None, 5.0, 10.0]


def test_pct_zero_safe(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int")
    assert [r[0] for r in df.select(S.pct("a", "b")).collect()] == [None, 25.0]


def test_truncate_and_format(spark):
    df = spark.createDataFrame([("x" * 41, 1234567.5), ("short", 2.5)], "t string, v double")
    got = df.select(S.truncate_label("t"), S.format_amount("v")).collect()
    assert got[0][0] == "x" * 37 + "..." and got[1][0] == "short"
    assert got[0][1] == "1 234 568" and got[1][1] == "2"  # half-to-even


def test_remote_flag_unicode_case(spark):
    df = spark.createDataFrame([("УДАЛЕННАЯ работа",), ("Remote",), (None,), ("офис",)], "s string")
    assert [r[0] for r in df.select(S.flag_regex("s")).collect()] == [True, True, False, False]


def test_tagging_token_and_word_boundaries(spark):
    vocab = ["C++", "C#", "Spring", "Spring Boot", "R", "Go", "Vue.js"]
    df = spark.createDataFrame([("we use c++ dev and c# daily",), ("Spring Boot, go!",), ("pythonразработчик r-lang",),
                                (None,), ("vue.js and vuejs",)], "t string")
    tok = [r[0] for r in df.select(T.tag_terms("t", vocab, "token")).collect()]
    assert tok == [["C++", "C#"], ["Spring", "Spring Boot", "Go"], ["R"], [], ["Vue.js"]]
    word = [r[0] for r in df.select(T.tag_terms("t", vocab, "word")).collect()]
    assert word[0] == []  # \bc\+\+\b cannot match "c++ dev"
    assert word[1] == ["Spring", "Spring Boot", "Go"]


def test_parse_list_text(spark):
    df = spark.createDataFrame([("['a b', 'c']",), ("x, y ,, z,",), (None,)], "k string")
    assert [r[0] for r in df.select(T.parse_list_text("k")).collect()] == [["a b", "c"], ["x", "y", "z"], []]


def test_parse_skill_input_keeps_order_and_duplicates(spark):
    df = spark.createDataFrame([("  Python, machine learning,python,, ",)], "s string")
    assert df.select(T.parse_skill_input("s")).first()[0] == ["python", "machine_learning", "python"]
