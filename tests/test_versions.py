from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from adjudica.operators import versions
from adjudica.operators.dedup import assert_primary_key, keep_first, keep_last_added
from adjudica.operators.ordered import placed

HOLDERS = "array<struct<titulaire:struct<typeIdentifiant:string,id:string>>>"
RECORD = (
    f"uid string, montant int, dureeMois int, acheteur_id string, titulaires {HOLDERS}, dateNotification string, "
    "datePublicationDonnees string, modification_dateNotificationModification string, "
    "modification_datePublicationDonneesModification string, modification_montant int, modification_dureeMois int, "
    f"modification_titulaires {HOLDERS}"
)


def holders(*ids):
    return [{"titulaire": {"typeIdentifiant": "SIRET", "id": i}} for i in ids]


def test_amendments_become_versions(frame):
    base = ("1", 1000, 12, "12345", holders("00013"), "2023-01-01", "2023-01-02")
    df = frame(
        RECORD,
        (*base, None, None, None, None, None),
        (*base, "2023-02-04", "2023-02-05", 1500, 18, holders("00011", "00012")),
        (*base, "2023-03-04", "2023-03-05", None, None, None),
        ("2", 500, 6, "99999", holders("0003"), "2023-03-01", "2023-03-02", None, None, None, None, None),
    )
    got = versions.apply_versions(df)
    shown = got.select(
        "uid", "dateNotification", "datePublicationDonnees", "montant", "dureeMois", "acheteur_id",
        F.array_join(F.transform("titulaires", lambda t: t["titulaire"]["id"]), "+"),
    )
    assert rows(shown) == [
        ("1", "2023-01-01", "2023-01-02", 1000, 12, "12345", "00013"),
        ("1", "2023-02-04", "2023-02-05", 1500, 18, "12345", "00011+00012"),
        ("1", "2023-03-04", "2023-03-05", 1500, 18, "12345", "00011+00012"),
        ("2", "2023-03-01", "2023-03-02", 500, 6, "99999", "0003"),
    ]


def test_version_numbers(frame):
    df = frame(
        "uid string, dateNotification date, montant double",
        ("A", date(2023, 1, 1), 100.0),
        ("A", date(2023, 1, 3), 300.0),
        ("A", date(2023, 1, 2), 300.0),
        ("A", date(2023, 1, 3), 301.0),
        ("A", None, 5.0),
        ("B", date(2023, 2, 1), 500.0),
        ("B", date(2023, 2, 2), 500.0),
        ("C", None, 1.0),
        (None, date(2023, 2, 2), 2.0),
    )
    got = versions.number_versions(df)
    assert dict(got.dtypes)["modification_id"] == "smallint"
    assert rows(got, "uid", "montant", "modification_id", "donneesActuelles") == sorted(
        [
            ("A", 100.0, 0, False),
            ("A", 300.0, 1, False),
            ("A", 300.0, 2, True),
            ("A", 301.0, 2, True),
            ("A", 5.0, None, None),
            ("B", 500.0, 0, False),
            ("B", 500.0, 1, True),
            ("C", 1.0, None, None),
            (None, 2.0, 0, True),
        ],
        key=repr,
    )
    ordered = [(r.uid, r.dateNotification) for r in versions.version_order(got.where("uid = 'A'")).collect()]
    assert ordered[0] == ("A", None) and ordered[1] == ("A", date(2023, 1, 3)) and ordered[-1] == ("A", date(2023, 1, 1))


def brute_force_fill(data):
    out, last = [], {}
    nulls_first = lambda v: (v is not None, v)
    for key, step, tie, a, b in sorted(data, key=lambda r: [nulls_first(v) for v in r]):
        held = last.setdefault(key, [None, None])
        held[:] = [a if a is not None else held[0], b if b is not None else held[1]]
        out.append((key, step, tie, *held))
    return sorted(out, key=repr)


def skewed_rows():
    """One key holds half of all rows, a third of those being copies of each other."""
    data = []
    for i in range(600):
        key = "hot" if i % 2 else f"k{i % 17}"
        if i % 6 == 1:
            data.append((key, "2020-01-05", 3, None, 7))
        else:
            data.append((key, f"2020-01-{i * 7 % 20:02d}", i * 5 % 4, None if i % 3 else i % 11, None if i % 5 else i % 13))
    return data + [(None, None, None, None, 1), (None, "2020", 1, 2, None)]


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", n)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("partitions", [1, 7])
def test_forward_fill_equals_brute_force_for_keys_that_span_partitions(frame, many_partitions, partitions):
    many_partitions(partitions)
    data = skewed_rows()
    df = frame("key string, step string, tie int, a int, b int", *data)
    assert rows(versions.forward_fill(df, ["key"], ["step", "tie"], ["a", "b"])) == brute_force_fill(data)


def test_a_key_whose_rows_have_one_date_spans_tasks(frame, many_partitions):
    many_partitions(8)
    data = [("hot" if i % 3 else f"k{i}", "2020", i, None if i % 4 else i, None) for i in range(2000)]
    df = frame("key string, step string, tie int, a int, b int", *data)
    assert rows(versions.forward_fill(df, ["key"], ["step", "tie"], ["a", "b"])) == brute_force_fill(data)
    dealt = placed(df, ["key", "step", "tie"])
    assert dealt.where("key = 'hot'").select("_part").distinct().count() >= 5


def test_version_folding_is_the_same_whatever_the_partitioning(frame, many_partitions):
    data = []
    for i in range(400):
        uid = "hot" if i % 3 else f"u{i % 20}"
        data.append((uid, i % 4 or None, i % 6, "b", holders(f"{i % 5}"), "2020-01-01", None,
                     f"2020-02-{i % 9:02d}" if i % 7 else None, None, i % 5 or None, None, holders("x") if i % 11 == 0 else None))
    df = frame(RECORD, *data)
    many_partitions(1)
    one = rows(versions.apply_versions(df))
    many_partitions(9)
    assert rows(versions.apply_versions(df)) == one


def test_numbering_shuffles_only_keys_and_dates_beside_the_rows_themselves(spark, frame, tmp_path):
    frame("uid string, dateNotification date, text string", ("A", date(2023, 1, 1), "x")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = versions.number_versions(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert len(scans) == 2 and sum("text:string" in line for line in scans) == 1


def test_a_key_with_a_third_of_the_rows_on_one_date(frame):
    data = [("hot", date(2023, 1, 1)) if i % 3 == 0 else (f"u{i % 50}", date(2023, 1, 1 + i % 7)) for i in range(3000)]
    got = versions.number_versions(frame("uid string, dateNotification date", *data))
    hot = got.where("uid = 'hot'").groupBy("modification_id", "donneesActuelles").count().collect()
    assert [tuple(r) for r in hot] == [(0, True, 1000)] and got.count() == 3000


def test_survivor_is_the_same_whatever_the_partitioning(spark, frame):
    df = frame("k int, v int, w string", *[(i % 5, i * 7 % 11, str(i % 3)) for i in range(200)])
    first = rows(keep_first(df.repartition(7), ["k"], [F.col("v").desc()]))
    assert first == rows(keep_first(df.repartition(2, "w"), ["k"], [F.col("v").desc()]))
    plan = keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # once before the shuffle, once after


def test_later_table_wins(frame):
    old = frame("k int, v string", (1, "old"), (2, "old"))
    new = frame("k int, v string", (2, "new"), (3, "new"))
    assert rows(keep_last_added([old, new], ["k"])) == [(1, "old"), (2, "new"), (3, "new")]


def test_primary_key_is_asserted(frame):
    df = frame("a int, b int", (1, 1), (1, 2))
    assert_primary_key(df, ["a", "b"])
    with pytest.raises(ValueError):
        assert_primary_key(df, ["a"])


def test_records_without_amendments_are_dealt_once(spark, frame):
    """Rows of keys without amendments skip the ranges; keys with one, and null keys, give what they gave."""
    df = frame(
        "uid string, dateNotification string, datePublicationDonnees string, montant string, dureeMois string, titulaires string, objet string, "
        "modification_dateNotificationModification string, modification_montant string",
        ("a", "2020", "p", "1", "2", "t", "o", None, None), ("a", "2020", "p", "1", "2", "t", "o", None, None),
        ("b", "2020", "p", "1", "2", "t", "o", None, None), ("b", "2020", "p", "1", "2", "t", "o", "2021", "7"),
        (None, "2020", "p", "1", None, "t", "o", None, None), (None, "2020", "p", "1", None, "t", "o", "2022", None),
    )
    got = versions.apply_versions(df)
    assert rows(got, "uid", "dateNotification", "montant", "dureeMois", "objet") == sorted([
        ("a", "2020", "1", "2", "o"), ("b", "2020", "1", "2", "o"), ("b", "2021", "7", "2", "o"), (None, "2020", "1", None, "o"), (None, "2022", "1", None, "o"),
    ], key=repr)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan
    none = versions.apply_versions(df.where("uid = 'a'"))
    assert rows(none, "uid", "montant") == [("a", "1")]
