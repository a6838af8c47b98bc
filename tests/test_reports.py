import json
from datetime import date
from statistics import median

import pytest
from conftest import rows
from pyspark.sql import functions as F

from adjudica.operators import counts, overlap, scores
from adjudica.plans import stats


def test_source_overlap(frame):
    df = frame(
        "uid int, sourceDataset string",
        (1, "ds1"), (2, "ds1"), (3, "ds1"), (2, "ds2"), (3, "ds2"), (4, "ds2"), (3, "ds3"), (5, "ds3"), (5, "ds3"),
    )
    for wide in (overlap.overlap_matrix(df, ["ds1", "ds2", "ds3"]), overlap.overlap_matrix_found(df)):
        got = {r.sourceDataset: r for r in wide.collect()}
        assert len(got) == 3 and len(wide.columns) == 5
        assert got["ds1"].unique == pytest.approx(1 / 3) and got["ds1"].ds2 == pytest.approx(2 / 3)
        assert got["ds1"].ds3 == pytest.approx(1 / 3) and got["ds1"].ds1 is None
        assert (got["ds3"].unique, got["ds3"].ds1, got["ds3"].ds2) == (0.5, 0.5, 0.5)
    assert rows(overlap.sources_per_key(df).where("n_sources = 3")) == [(3, 3)]


PAIRS = "uid string, codeCPV string, activite_code string, activite_nomenclature string, donneesActuelles boolean"


def test_no_usable_pairs_give_no_scores(frame):
    df = frame(PAIRS, ("M1", "45000000", None, None, True), ("M2", "45000000", None, None, True))
    assert scores.activity_product_scores(df).count() == 0


def test_record_counts_even_if_one_holder_has_no_activity(frame):
    data = [(f"M{i}", "45000000", a, n, True) for i in range(30) for a, n in ((None, None), ("43.21B", "NAFREV2"))]
    got = scores.activity_product_scores(frame(PAIRS, *data)).collect()
    assert [tuple(r) for r in got] == [("NAFREV2", "43.21B", "45000000", 1.0, 1, 30)]


def test_ranks_are_dense_and_end_at_ten(frame):
    data = [(f"{i}-{j}", f"{i:08d}", " a ", "n", True) for i in range(1, 15) for j in range((i + 1) // 2 + 3)]
    got = scores.activity_product_scores(frame(PAIRS, *data))
    ranks = {r.cpv: r["rank"] for r in got.collect()}
    assert set(ranks.values()) == set(range(1, 8)) and ranks["00000014"] == ranks["00000013"] == 1
    assert scores.ranked_shares(got.select(F.lit(1).alias("g"), "cpv"), "g", "cpv", 1).count() == 14  # all tie


@pytest.mark.parametrize("ranges", [1, 4])
def test_median_is_exact(spark, frame, ranges):
    groups = {
        "even": [4.0, 1.0, 3.0, 2.0],
        "odd": [5.0, 1.0, 1.0],
        "one": [7.5],
        "ties": [2.0] * 400 + [1.0, 3.0],
        "split": [1.0] * 50 + [9.0] * 50,
        "spread": [float(i * 37 % 1009) for i in range(1008)],
    }
    data = [(g, v) for g, vs in groups.items() for v in vs] + [("void", None), (None, 1.0), (None, 2.0)]
    name, df = "spark.sql.adaptive.coalescePartitions.enabled", frame("g string, v double", *data)
    before = spark.conf.get(name)
    spark.conf.set(name, ranges == 1)  # if not, one group spans several ranges
    try:
        got = dict(rows(counts.exact_median(df, ["g"], "v", "m")))
        overall = rows(counts.exact_median(df, [], "v", "m"))
    finally:
        spark.conf.set(name, before)
    assert got == {**{g: median(v) for g, v in groups.items()}, None: 1.5}
    assert overall == [(median([v for _, v in data if v is not None]),)]
    assert rows(counts.exact_median(df.limit(0), ["g"], "v", "m")) == []


def test_shares(frame):
    df = frame("status string", ("a",), ("a",), ("b",))
    assert rows(counts.shares(df, "status")) == [("a", 2, 66.7), ("b", 1, 33.3)]


CONTRACTS = (
    "uid string, acheteur_id string, titulaire_id string, titulaire_typeIdentifiant string, dateNotification date, "
    "datePublicationDonnees date, montant double, donneesActuelles boolean, sourceDataset string, sourceFile string"
)


@pytest.fixture
def contracts(frame):
    d = date
    return frame(
        CONTRACTS,
        ("1", "b1", "h1", "SIRET", d(2019, 1, 1), d(2019, 2, 1), 10.9, True, "s1", "f1"),
        ("1", "b1", "h2", "SIRET", d(2019, 1, 1), d(2019, 2, 1), 10.9, True, "s1", "f1"),
        ("1", "b1", "h1", "SIRET", d(2018, 1, 1), d(2019, 2, 1), 5.0, False, "s1", "f1"),
        ("2", "b2", None, None, d(2019, 6, 1), None, 20.2, True, "s2", "f2"),
        ("3", None, "h1", "TVA", d(2021, 6, 1), d(2021, 6, 1), None, True, "s2", "f2"),
    )


def test_yearly_stats(contracts):
    current = stats.current_records(contracts)
    assert current.count() == 3
    got = stats.yearly_stats(contracts, current, date(2021, 12, 31))
    assert rows(got) == [
        (2018, 0, 0, None, None, None, None),
        (2019, 1, 2, 31, 15, 2, 3),  # a missing holder counts as one
        (2020, 0, 0, None, None, None, None),
        (2021, 1, 1, 0, 0, 1, 1),
    ]


def test_statistics_document(contracts, tmp_path):
    from adjudica.sinks.files import write_document

    write_document(stats.contract_stats(contracts, date(2021, 12, 31)), str(tmp_path / "stats"))
    (file,) = (tmp_path / "stats").glob("*.json")
    document = json.loads(file.read_text())
    assert (document["nb_lignes"], document["nb_marches"], document["nb_resources"], document["sources"]) == (5, 3, 2, ["s1", "s2"])
    # Buyers: two and the missing one, less one. Holders: three and the missing one, less one.
    assert (document["nb_acheteurs_uniques"], document["nb_titulaires_uniques"], document["nb_colonnes"]) == (2, 3, 10)
    assert document["2019"]["mediane_montant_marches_notifies"] == 15 and "2020" in document


def test_totals(contracts):
    assert rows(stats.totals(contracts), "amount", "n_records", "n_rows", "n_buyers", "n_holders") == [(31, 3, 4, 3, 3)]


def test_source_report_takes_names_from_the_entry_before(frame):
    current = frame(
        "uid string, acheteur_id string, sourceDataset string",
        ("1", "b1", "alpha"), ("2", "b1", "alpha"), ("3", "b2", "decp_minef_x"), ("4", None, "decp_minef_y"), ("5", "b", "aaa"),
    )
    registry = frame(
        "id string, name string, owner_org_name string, code string",
        ("1", "Alpha", "Org A", "alpha"), ("2", "Unused", "Org U", "unused"), ("3", "Merged", "Org M", "decp_minef"),
    )
    pairs = overlap.overlap_pairs(current)
    alone = pairs.where("sourceDataset = other").select("sourceDataset", "unique")
    got = [tuple(r) for r in stats.source_stats(current, registry, alone).select("code", "nom", "nb_marchés", "nb_acheteurs").collect()]
    assert got == [
        ("alpha", "Alpha", 2, 1),
        ("aaa", None, 1, 1),  # nothing before it
        ("decp_minef_x", "Alpha", 1, 1),
        ("decp_minef_y", "Alpha", 1, 1),
    ]


def test_resource_profile(frame):
    df = frame("file string, a int, b string", ("f1", 1, None), ("f1", None, None), ("f2", None, "x"))
    meta = frame("file string, views bigint", ("f1", 7))
    assert rows(stats.resource_profile(df, "file", meta)) == [("f1", 2, ["a"], 1, 7), ("f2", 1, ["b"], 1, None)]
