import json
from datetime import date

import pytest
from conftest import rows, values
from pyspark.sql import functions as F
from test_registers import CACHE, COMPANIES, SITES
from test_sources import NEW, OLD, STRANGER, TOWN, WORKSHOP, XML

from adjudica.plans import nightly
from adjudica.sources import manifest
from adjudica.sources.layouts import CONTRACT_COLUMNS
from adjudica.streaming.intake import take_in_lines

AS_OF = date(2026, 5, 15)
MANIFEST = "dataset_id string, dataset_code string, id string, url string, format string, checksum string, filesize bigint"


@pytest.fixture
def resources(frame, tmp_path):
    (tmp_path / "in put").mkdir()
    paths = {}
    for name, text in {"old.json": json.dumps(OLD), "copy.json": json.dumps(OLD), "new.json": json.dumps(NEW)}.items():
        (tmp_path / "in put" / name).write_text(text)
    (tmp_path / "in put" / "x.xml").write_bytes(XML.encode("ISO-8859-15"))
    place = str(tmp_path / "in put")
    return frame(
        MANIFEST,
        ("d1", "decp_minef", "r1", f"{place}/old.json", "json", "c1", 900),
        ("d2", "other", "r2", f"{place}/copy.json", "json", "c2", 900),
        ("d2", "other", "r3", f"{place}/new.json", "json", "c3", 900),
        ("d3", "third", "r4", f"{place}/x.xml", "xml", "c4", 900),
        ("d3", "third", "r5", f"{place}/absent.json", "json", "c5", 10),
    )


@pytest.fixture
def registers(frame):
    place = (48.0, 2.0, "12345", "Commune", "12", "Département", "01", "Région")
    companies = frame(COMPANIES, ("700000002", "Atelier Nord", "PME", "5499"), ("800000001", "Mairie d'Essai", None, "7210"))
    sites = frame(
        SITES,
        (WORKSHOP, *place, "Quai", "16.23Z", "NAFRev2"),
        (TOWN, *place, None, "84.11Z", "NAFRev2"),
    )
    cache = frame(CACHE, (WORKSHOP, 48.0, 2.0, "decp", None, None, "success"))
    registry = frame(
        "id string, name string, owner_org_name string, code string",
        ("d1", "Merged", "Org", "decp_minef"), ("d2", "Other", "Org", "other"), ("d3", "Third", "Org", "third"),
    )
    return companies, sites, cache, registry


def test_documents_to_published_tables(spark, resources, registers, tmp_path):
    out = str(tmp_path / "clean")
    taken = nightly.ingest(spark, resources, None, out, AS_OF).taken
    assert sorted(values(taken, "id")) == ["r1", "r2", "r3", "r4"]
    cleaned = spark.read.parquet(out)
    # Three documents: two records of the older layout twice, one of the newer, one in XML.
    assert cleaned.select("sourceFile").distinct().count() == 4
    assert "https://www.data.gouv.fr/datasets/d1/#/resources/r1" in values(cleaned, "sourceFile")
    assert {"decp_minef_sender", "other", "third"} <= set(values(cleaned, "sourceDataset"))

    before = rows(cleaned)
    repeated = nightly.ingest(spark, resources, None, out, AS_OF).taken
    assert repeated.count() == 4 and rows(spark.read.parquet(out)) == before

    again = nightly.ingest(spark, resources, taken, out, AS_OF).taken
    assert again.count() == 0 and spark.read.parquet(out).count() == len(before)

    companies, sites, cache, registry = registers
    result = nightly.publish([spark.read.parquet(out)], companies, sites, cache, registry, AS_OF)
    contracts = nightly.write_published(result, str(tmp_path / "published"))
    assert contracts.columns[: len(CONTRACT_COLUMNS)] == CONTRACT_COLUMNS
    assert contracts.columns == CONTRACT_COLUMNS
    # Two holders, three versions: the amount of the first amendment lasts, the last one has one holder only.
    one = contracts.where(f"uid = '{STRANGER}lot_7_a'")
    assert rows(one, "modification_id", "donneesActuelles", "montant", "dureeMois", "titulaire_id", "titulaire_nom") == [
        (0, False, 1250.5, 24, WORKSHOP, "Atelier Nord (Quai)"),
        (0, False, 1250.5, 24, "EU-55", None),
        (1, False, 1600.0, 24, WORKSHOP, "Atelier Nord (Quai)"),
        (1, False, 1600.0, 24, "EU-55", None),
        (2, True, 1600.0, 36, WORKSHOP, "Atelier Nord (Quai)"),
    ]
    # No date: neither number nor flag. The amount is one of those that cannot be.
    undated = rows(contracts.where(f"uid = '{TOWN}K-1'"), "montant", "acheteur_nom", "acheteur_categorie", "titulaire_id", "modification_id")
    assert undated == [(12311111111.0, "Mairie d'Essai", "Commune", WORKSHOP, None), (8.25, "Mairie d'Essai", "Commune", "EU-55", None)]
    newest_first = [d for d in values(contracts, "dateNotification")]
    assert newest_first == sorted([d for d in newest_first if d], reverse=True) + [None] * newest_first.count(None)
    new_cache = dict(rows(spark.read.parquet(str(tmp_path / "published/geocode_cache.parquet")), "siret", "status"))
    assert new_cache[WORKSHOP] == "success" and new_cache[STRANGER] == "not_in_sirene"
    share = {(r.sourceDataset, r.other): r.share for r in result.overlap.collect()}
    assert share[("decp_minef_sender", "other")] == 1.0 and share[("other", "decp_minef_sender")] == pytest.approx(1 / 3)
    assert ("other", "third") not in share
    stats = json.loads(next((tmp_path / "published/statistics.json").glob("*.json")).read_text())
    assert stats["nb_marches"] == contracts.where("donneesActuelles").select("uid").distinct().count()


def test_xml_of_any_encoding_and_with_control_characters(spark, frame, tmp_path):
    texts = {
        "latin": XML.encode("ISO-8859-15"),
        "utf": XML.replace("ISO-8859-15", "utf-8").encode(),
        "bare": XML.split("\n", 1)[1].encode(),
        "damaged": XML.replace("ISO-8859-15", "utf-8").replace("Marché", "Mar\x01ché").encode(),
        "damaged_latin": XML.replace("Marché", "Mar\x01ché").encode("ISO-8859-15"),
        "attributed": XML.replace("ISO-8859-15", "utf-8").replace("Marché", "Mar\x01ché").replace("<marche>", '<marche type="m">').encode(),
    }
    listed = []
    for name, data in texts.items():
        (tmp_path / f"{name}.xml").write_bytes(data)
        listed.append(("d", "code", name, str(tmp_path / f"{name}.xml"), "xml", f"sum-{name}", 900))
    read = nightly.read_resources(spark, frame(MANIFEST, *listed))
    assert set(read.flat) == {"2022"} and values(read.outcomes, "reason") == [None] * len(texts) and read.rejects.count() == 0
    assert rows(read.flat["2022"].select("checksum", "nature").distinct()) == sorted((f"sum-{n}", "Marché") for n in texts)


def test_new_files_of_a_folder_are_taken_once(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    record = NEW["marches"]["marche"][0]
    (folder / "a.json").write_text(json.dumps(record))
    where = (str(folder), str(tmp_path / "out"), str(tmp_path / "progress"), "code", AS_OF)
    take_in_lines(spark, *where)
    first = spark.read.parquet(where[1])
    assert set(values(first, "id")) == {"K-1"} and set(values(first, "sourceDataset")) == {"code"}
    take_in_lines(spark, *where)
    assert spark.read.parquet(where[1]).count() == first.count()
    (folder / "b.json").write_text(json.dumps({**record, "id": "K-2"}))
    take_in_lines(spark, *where)
    assert set(values(spark.read.parquet(where[1]), "id")) == {"K-1", "K-2"}
    (folder / "c.json").write_text('{"id":\n')
    take_in_lines(spark, *where)
    assert values(spark.read.parquet(where[1] + "-rejects"), "line") == ['{"id":']


def test_one_bad_resource_neither_stops_nor_silences_a_run(spark, frame, tmp_path):
    files = {
        "good.json": json.dumps(NEW),
        "late.json": json.dumps({"meta": {"marches": ["x"]}, "marches": {"version": "2", **NEW["marches"]}}),
        "empty.json": json.dumps({"marches": []}),
        "broken.json": json.dumps(NEW)[:-5],
        "odd.json": json.dumps({"contracts": []}),
        "partly.xml": "<marches><marche><id>1</id><acheteur><id>2</id></acheteur></marche><marche><id>2</a></marche></marches>",
        "ruined.xml": "<marches><marche><id>2</a></marche></marches>",
        "bare.xml": "<marches></marches>",
        "nothing.xml": "",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    names = [*files, "absent.json", "absent.xml"]
    listed = [("d", "code", n, str(tmp_path / n), n.split(".")[1], f"sum-{n}", 900) for n in names]
    result = nightly.ingest(spark, frame(MANIFEST, *listed), None, str(tmp_path / "out"), AS_OF)
    assert rows(result.taken, "id", "n_rejects") == [("empty.json", 0), ("good.json", 0), ("late.json", 0), ("partly.xml", 1)]
    assert rows(result.refused, "id", "reason") == [
        ("absent.json", "missing"), ("absent.xml", "missing"), ("bare.xml", "no records"), ("broken.json", "unreadable"),
        ("nothing.xml", "no records"), ("odd.json", "no records"), ("ruined.xml", "unreadable"),
    ]
    assert rows(result.rejects, "checksum", "record") == [(f"sum-{n}.xml", "<marche><id>2</a></marche>") for n in ("partly", "ruined")]
    # The same files by the way of those that are too large for one text.
    blocks = nightly.read_resources(spark, frame(MANIFEST, *[x for x in listed if x[4] == "json"]), largest_text=0)
    assert rows(blocks.outcomes.select(F.element_at(F.split("_path", "/"), -1).alias("f"), "reason")) == [
        ("absent.json", "missing"), ("broken.json", "unreadable"), ("empty.json", None), ("good.json", None), ("late.json", None), ("odd.json", "no records"),
    ]
    small = nightly.read_resources(spark, frame(MANIFEST, *[x for x in listed if x[4] == "json"]))
    assert rows(blocks.flat["2022"]) == rows(small.flat["2022"]) and blocks.flat["2019"].count() == 0
    later = nightly.ingest(spark, frame(MANIFEST, *listed), result.taken, str(tmp_path / "out"), AS_OF)
    assert later.taken.count() == 0 and later.refused.count() == 7


def test_replaced_and_withdrawn_resources_are_gone(spark, frame, registers, tmp_path):
    def document(name, **amounts):
        record = NEW["marches"]["marche"][0]
        kept = [{**record, "id": i, "montant": amount, "modifications": []} for i, amount in amounts.items()]
        (tmp_path / f"{name}.json").write_text(json.dumps({"marches": {"marche": kept}}))
        return str(tmp_path / f"{name}.json")

    r1, r2, r3 = document("r1", c1=100, c2=5), document("r2", c9=7), document("r3", c1=100, c2=5)
    out, states = str(tmp_path / "clean"), MANIFEST + ", last_modified string"
    first = frame(states, ("d", "code", "r1", r1, "json", "s1", 900, "2026-01-01"), ("d", "code", "r2", r2, "json", "t1", 900, "2026-01-01"))
    done = nightly.ingest(spark, first, None, out, AS_OF).taken
    assert done.count() == 2
    r1 = document("r1", c1=900)
    second = frame(
        states,
        ("d", "code", "r1", r1, "json", "s2", 900, "2026-02-01"), ("d", "code", "r1", r1, "json", "s1", 900, "2026-01-01"),
        ("e", "other", "r1", r3, "json", "s1", 900, "2026-01-01"),  # content that was taken in before, under another resource
    )
    taken = nightly.ingest(spark, second, done, out, AS_OF).taken
    assert sorted(rows(taken, "dataset_id", "checksum")) == [("d", "s2"), ("e", "s1")]

    def amounts(listed, dataset):
        result = nightly.publish([spark.read.parquet(out)], *registers, AS_OF, listed=listed)
        return rows(result.contracts.where(f"sourceDataset = '{dataset}'").select("id", "montant").distinct())

    assert amounts(first, "code") == [("c1", 100.0), ("c2", 5.0), ("c9", 7.0)]
    assert amounts(second.where("dataset_id = 'd'"), "code") == [("c1", 900.0)]
    assert amounts(second.where("dataset_id = 'e'"), "other") == [("c1", 100.0), ("c2", 5.0)]
    assert nightly.publish([spark.read.parquet(out)], *registers, AS_OF, listed=second.limit(0)).contracts.count() == 0
    plan = manifest.only_current(spark.read.parquet(out), second)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
