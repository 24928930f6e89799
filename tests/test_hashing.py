import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakevault.functions.hashing import all_present, digest

ASCII = st.text(st.characters(min_codepoint=32, max_codepoint=126), max_size=8)


def test_case_and_outer_spaces_do_not_matter(spark):
    row = spark.createDataFrame([(" abc ", "ABC")], "a string, b string").select(
        digest(["a"]).alias("a"), digest(["b"]).alias("b")
    ).first()
    assert row["a"] == row["b"] == hashlib.sha256(b"ABC").hexdigest()


def test_only_spaces_are_trimmed(spark):
    row = spark.createDataFrame([("\tabc\n",)], "a string").select(digest(["a"]).alias("a")).first()
    assert row["a"] == hashlib.sha256(b"\tABC\n").hexdigest()


def test_null_equals_empty_and_separator_can_collide(spark):
    row = spark.createDataFrame([(None, "", "A||B", "C", "A", "B||C")], "n string, e string, p string, q string, r string, s string")
    got = row.select(
        digest(["n"]).alias("n"), digest(["e"]).alias("e"), digest(["p", "q"]).alias("pq"), digest(["r", "s"]).alias("rs")
    ).first()
    assert got["n"] == got["e"]
    assert got["pq"] == got["rs"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.none() | ASCII, st.none() | ASCII, st.none() | st.integers(-(2**31), 2**31 - 1)), min_size=1, max_size=40))
def test_digest_follows_the_recipe(spark, rows):
    def expected(parts):
        return hashlib.sha256("||".join("" if p is None else str(p).strip(" ").upper() for p in parts).encode()).hexdigest()

    frame = spark.createDataFrame(rows, "a string, b string, c int")
    got = frame.select("a", "b", "c", digest(["a", "b", "c"]).alias("h")).collect()
    assert all(r["h"] == expected((r["a"], r["b"], r["c"])) for r in got)


def test_rows_with_a_missing_key_part_are_told_apart(spark):
    frame = spark.createDataFrame([("a", "b"), ("a", None), (None, None)], "x string, y string")
    assert frame.where(all_present(["x", "y"])).count() == 1
    assert frame.where(all_present([])).count() == 3
