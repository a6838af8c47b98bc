import json
import time
from datetime import date
from types import SimpleNamespace

import pytest
from conftest import rows, values
from pyspark.sql import functions as F

from adjudica.functions import nested
from adjudica.session import materialise
from adjudica.sources import documents, elements, large_json, manifest, pages, repair, tables

def party(number, kind="SIRET", **more):
    return {"typeIdentifiant": kind, "id": number, **more}


# Invented parties: a town, a buyer no register knows, and two holders.
TOWN, STRANGER, WORKSHOP = "80000000100015", "60000000300033", "70000000200024"
NORTH, ABROAD = party(WORKSHOP, denominationSociale="Atelier Nord"), party("EU-55", "TVA")
# The older layout: amendments bare and wrapped in one list, an empty holder list, a record without amendments.
OLD = {
    "marches": [
        None,
        {
            "id": "lot.7/a",
            "acheteur.id": STRANGER,
            "dateNotification": "2020-02-29",
            "montant": 1250.5,
            "dureeMois": 24,
            "titulaires": [NORTH, ABROAD],
            "considerationsSociales": ["Clause sociale", "Marché réservé"],
            "lieuExecution": {"typeCode": "Code commune", "code": "29019"},
            "source": "sender",
            "modifications": [
                {"modification": {"dateNotificationModification": "2020-09-30", "montant": 1600}},
                {"dateNotificationModification": "2021-03-31", "dureeMois": 36, "titulaires": [[[NORTH]]]},
            ],
        },
        {"id": "lot.8", "acheteur": {"id": TOWN}, "dateNotification": "2020-13-01", "montant": "NC", "titulaires": [], "modifications": []},
    ]
}
# The newer layout: a text among the holders, an amount that cannot be, an amendment with a new holder.
NEW = {
    "marches": {
        "marche": [
            {
                "id": "K-1",
                "acheteur": {"id": TOWN},
                "montant": 2.0e17,
                "typesPrix": {"typePrix": ["Définitif ferme"]},
                "modalitesExecution": {"modaliteExecution": ["Tranches", "Bons de commande"]},
                "titulaires": [{"titulaire": "inconnu"}, {"titulaire": NORTH}],
                "modifications": [{"modification": {"montant": 8.25, "titulaires": [{"titulaire": ABROAD}]}}],
                "concessionnaires": [{"id": 3}],
            }
        ]
    }
}


def ids(holders):
    return None if holders is None else [(h.titulaire_id, h.titulaire_typeIdentifiant) for h in holders]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "old.json").write_text("\ufeff" + json.dumps(OLD))
    (tmp_path / "new.json").write_text(json.dumps(NEW, indent=2, ensure_ascii=False))
    (tmp_path / "other.json").write_text('{"concessions": []}')
    (tmp_path / "broken.json").write_text('{"marches": [')
    return str(tmp_path)


def test_layouts_are_told_apart_and_flattened(spark, folder):
    payloads = documents.read_payloads(spark, folder)
    good, bad = repair.split_rejects(payloads)
    assert [p.rsplit("/")[-1] for p in values(bad, "path")] == ["broken.json"]
    assert [p.rsplit("/")[-1] for p in values(documents.rejected(good), "path")] == ["other.json"]

    old = documents.flatten(documents.records(good, "2019"), "2019")
    assert rows(old, "id", "`acheteur.id`", "acheteur_id", "montant", "dureeMois", "modification_montant", "modification_dureeMois") == [
        ("lot.7/a", STRANGER, None, "1250.5", "24", "1600", None),
        ("lot.7/a", STRANGER, None, "1250.5", "24", None, "36"),
        ("lot.7/a", STRANGER, None, "1250.5", "24", None, None),
        ("lot.8", None, TOWN, "NC", None, None, None),
    ]
    first = old.where("id = 'lot.7/a'").orderBy(F.col("modification_dateNotificationModification").asc_nulls_first())
    tidy = nested.tidy_holders(F.col("modification_titulaires"), "2019")
    assert [ids(r.h) for r in first.select(tidy.alias("h")).collect()] == [None, None, [(WORKSHOP, "SIRET")]]
    assert values(first, "considerationsSociales")[0] == ["Clause sociale", "Marché réservé"]
    assert set(values(first, "lieuExecution_code")) == {"29019"}

    new = documents.flatten(documents.records(good, "2022"), "2022")
    assert new.count() == 2 and "acheteur.id" not in new.columns
    base = new.where("modification_montant is null").first()
    assert base.typesPrix_typePrix == ["Définitif ferme"]
    assert base.modalitesExecution_modaliteExecution == ["Tranches", "Bons de commande"]
    shown = new.select(nested.tidy_holders(F.col("titulaires"), "2022").alias("h"), "modification_montant")
    assert {(str(ids(r.h)), r.modification_montant) for r in shown.collect()} == {
        (str([(WORKSHOP, "SIRET")]), None),
        (str([(WORKSHOP, "SIRET")]), "8.25"),
    }


def test_record_lines(spark, tmp_path):
    lines = [json.dumps(r) for r in NEW["marches"]["marche"]]
    (tmp_path / "lines.json").write_text("\n".join(lines))
    flat = documents.flatten(documents.read_record_lines(spark, str(tmp_path)), "2022")
    assert flat.count() == 2 and set(values(flat, "acheteur_id")) == {TOWN}


XML = """<?xml version="1.0" encoding="ISO-8859-15"?>
<marches>
 <marche>
  <id>x/1</id><nature>Marché</nature>
  <acheteur><id>80000000100015</id></acheteur>
  <montant>
   75.10
  </montant>
  <modifications><modification><dateNotificationModification>2024-07-01</dateNotificationModification></modification></modifications>
  <techniques><technique>Enchère</technique><technique>Catalogue</technique></techniques>
  <titulaires><titulaire><typeIdentifiant>TVA</typeIdentifiant><id>EU-55</id></titulaire></titulaires>
 </marche>
</marches>
"""


def test_xml_records(spark, tmp_path):
    (tmp_path / "small.xml").write_bytes(XML.encode("ISO-8859-15"))
    flat = documents.flatten_xml(elements.read_xml_records(spark, str(tmp_path / "small.xml")))
    assert rows(flat, "id", "acheteur_id", "nature", "montant", "modification_dateNotificationModification") == [
        ("x/1", TOWN, "Marché", "75.10", "2024-07-01"),
        ("x/1", TOWN, "Marché", "75.10", None),
    ]
    first = flat.first()
    assert first.techniques_technique == ["Enchère", "Catalogue"]
    assert ids(flat.select(nested.tidy_holders(F.col("titulaires"), "2022").alias("h")).first().h) == [("EU-55", "TVA")]


def test_broken_elements_are_rejects_and_the_others_are_read(spark, tmp_path):
    def record(i, more=""):
        return f"<marche><id>{i}</id>{more}</marche>"

    head, tail = '<?xml version="1.0" encoding="{}"?>\n<marches>', "</marches>\n"
    texts = {
        "broken": head.format("UTF-8") + record(1) + record(2, "<objet>&nbsp;</nature>") + record(3) + tail,
        "unended": head.format("UTF-8") + record(1) + "<marche><id>2</id> <marche a='1'><id>3</id></marche >\n" + record(4) + tail,
        "stopped": head.format("UTF-8") + record(1) + "<marche><id>2</id>",
        "ended": head.format("UTF-8") + record(1),
        "none": head.format("UTF-8") + tail,
        "marked_stop": "\ufeff" + head.format("UTF-8") + "<marche><id>2</id>",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.xml").write_text(text)
    latin = head.format("windows-1252") + record(1, "<nature>œuvre\x01 € é</nature>") + tail
    (tmp_path / "latin.xml").write_bytes(latin.encode("windows-1252"))
    (tmp_path / "marked.xml").write_bytes(b"\xef\xbb\xbf" + (head.format("utf-8") + record(1)).encode())
    (tmp_path / "none_at_all.xml").write_bytes(b"<marches/>")
    found, files = elements.read_elements(spark, str(tmp_path))
    got = elements.judged(found).select(F.element_at(F.split("path", "/"), -1).alias("f"), "id", elements.REJECTED, "nature")
    read = {(r.f, r.id) for r in got.where(f"{elements.REJECTED} is null").collect()}
    assert read == {
        ("broken.xml", "1"), ("broken.xml", "3"), ("unended.xml", "1"), ("unended.xml", "3"), ("unended.xml", "4"), ("stopped.xml", "1"),
        ("ended.xml", "1"), ("latin.xml", "1"), ("marked.xml", "1"),
    }
    bad = {r.f: r[elements.REJECTED] for r in got.where(f"{elements.REJECTED} is not null").collect()}
    assert bad.keys() == {"broken.xml", "unended.xml", "stopped.xml", "marked_stop.xml"} and all("<id>2</id>" in b for b in bad.values())
    assert values(got.where("f = 'latin.xml'"), "nature") == ["œuvre € é"]
    assert set(values(files, "whole")) == {True} and files.count() == 9


def test_elements_are_the_same_however_a_file_is_split(spark, tmp_path):
    text = '<?xml version="1.0" encoding="ISO-8859-1"?><marches>' + "".join(f"<marche><id>{i}</id><objet>{'é' * (i % 90)}</objet></marche>\n" for i in range(3000)) + "</marches>"
    (tmp_path / "large.xml").write_bytes(text.encode("ISO-8859-1"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3001")
    try:
        found = elements.read_xml_records(spark, str(tmp_path / "large.xml"))
        assert {(int(r.id), r.objet or "") for r in found.collect()} == {(i, "é" * (i % 90)) for i in range(3000)}
        scan = spark.read.option("lineSep", "</marche>").text(str(tmp_path / "large.xml"))
        assert scan.rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_each_element_is_parsed_once(frame):
    found = elements.judged(frame("path string, element string, cut boolean", ("p", "<marche><id>1</id></marche>", False), ("p", "<marche><id>2</marche>", False), ("p", None, True)))
    good = documents.flatten_xml(found.where(f"{elements.REJECTED} is null and id is not null").drop(elements.REJECTED))
    assert good._jdf.queryExecution().executedPlan().toString().count("from_xml(") == 1
    assert values(good, "id") == ["1"] and sorted(values(found, elements.REJECTED), key=str) == ["<marche><id>2</marche>", None, None]


def test_lines_that_are_no_record_are_reported(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"id":"1"}\n{"id":"2",\n\n  \n[1]\n"x"\n{"id":"3"}\n')
    assert values(documents.read_record_lines(spark, str(tmp_path)), "id") == ["1", "3"]
    assert sorted(values(documents.rejected_lines(spark, str(tmp_path)), "line")) == ['"x"', "[1]", '{"id":"2",']


def test_one_record_in_place_of_a_list(frame):
    texts = ['{"marches":{"marche":{"id":"7"}}}', '{"marches":{"marche":"no"}}', '{"marches":{"marche": [ {"id":"8"} ]}}']
    payloads = frame("path string, payload string", *[(str(i), t) for i, t in enumerate(texts)])
    assert rows(documents.records(payloads, "2022"), "path", "id") == [("0", "7"), ("2", "8")]
    assert values(documents.rejected(payloads), "path") == ["1"]


def test_payload_repairs(frame):
    given = {
        "bom": '\ufeff{"a":1}',
        "nan": '{"a":NaN,"b":NaN\n}',
        "quotes": '[{"objet":"un "vrai" titre \\"x\\"","montant":1},{"objet":"autre","montant":2}]',
        "lost": '{"a":',
    }
    df = frame("k string, payload string", *given.items())
    good, bad = repair.split_rejects(df)
    assert dict(rows(good)) == {
        "bom": '{"a":1}',
        "nan": '{"a":null,"b":null\n}',
        "quotes": '[{"objet":"un \\"vrai\\" titre \\"x\\"","montant":1},{"objet":"autre","montant":2}]',
    }
    assert values(bad, "k") == ["lost"]
    slashes = frame("v string", ("a\\\\\\b c\\\\d e\\ f",))
    assert slashes.select(repair.stray_backslashes(F.col("v"))).first()[0] == "a\\b c\\d e f"
    with_words = repair.split_rejects(frame("payload string", ('{"a":oops}',)), replacements={"oops": "1"})[0]
    assert values(with_words, "payload") == ['{"a":1}']


def test_resources_are_selected(frame):
    listed = frame(
        "dataset_id string, dataset_name string, dataset_code string, id string, title string, format string, url string, created_at string,"
        "last_modified string, checksum string, analysis_checksum string, filesize bigint, analysis_filesize bigint, views bigint",
        ("d", "D", "code", "abcdef", "My.File.JSON", "json", "u", "c", "m", "sum", "other", 500, None, 3),
        ("d", "D", "code", "bcdefg", "b.xml", "xml", "u", "c", "m", None, "other", None, 100, None),
        ("d", "D", "code", "cdefgh", "c.json", "json", "u", "c", "m", None, None, None, None, None),
        ("d", "D", "code", "excluded", "d.json", "json", "u", "c", "m", "s", None, 900, None, None),
        ("d", "D", "code", "table", "e.csv", "csv", "u", "c", "m", "s", None, 900, None, None),
    )
    got = manifest.resources(listed, excluded=["excluded"])
    assert rows(got, "id", "checksum", "filename", "filesize") == [
        ("abcdef", "sum", "d_my_file_abc", 500),
        ("bcdefg", "other", "d_b_bcd", 100),
        ("cdefgh", "cdefgh", "d_c_cde", 1000),
    ]
    kept = manifest.large_enough(got)
    assert sorted(values(kept, "id")) == ["abcdef", "cdefgh"]
    fresh = manifest.not_yet_ingested(kept, frame("checksum string", ("sum",)))
    assert values(fresh, "id") == ["cdefgh"]
    assert manifest.not_yet_ingested(kept, kept).count() == 0


def test_datasets_are_tracked(frame):
    df = frame("id string, skip boolean, deleted_date string", ("a", None, None), ("b", True, None), ("c", False, "2024"), ("d", False, None))
    assert sorted(values(manifest.tracked(df), "id")) == ["a", "d"]
    assert values(manifest.tracked(df, only=["b"]), "id") == ["b"]


def test_page_links(frame):
    html = (
        '<a title="Télécharger au format Json" href="/a.json">x</a><a href="/b">y</a>'
        '<a class="z"\n href="/c.json" title="Télécharger au format Json">'
    )
    df = frame("html string", (html,))
    assert sorted(values(pages.titled_links(df, site="https://s"), "link")) == ["https://s/a.json", "https://s/c.json"]
    assert sorted(values(pages.all_links(df), "link")) == ["/a.json", "/b", "/c.json"]


CATALOGUE = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:dcat="http://www.w3.org/ns/dcat#"
 xmlns:dct="http://purl.org/dc/terms/" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#"><dcat:catalog>
<dcat:dataset><dct:issued>2024-05-06</dct:issued><rdfs:ressource> https://k/xml/1 </rdfs:ressource><rdfs:ressource>https://k/json/1</rdfs:ressource></dcat:dataset>
<dcat:dataset><dcat:distribution><rdfs:ressource>https://k/json/2</rdfs:ressource></dcat:distribution></dcat:dataset>
<dcat:dataset><dct:issued>2024-05-06</dct:issued></dcat:dataset>
</dcat:catalog></rdf:RDF>"""


def test_catalogue_urls(spark, tmp_path):
    (tmp_path / "dcat.xml").write_text(CATALOGUE)
    urls = pages.catalogue_urls(pages.read_catalogue(spark, str(tmp_path / "dcat.xml")))
    assert rows(urls) == [("https://k/json/1", "2024-05"), ("https://k/json/2", None)]
    assert pages.json_urls_only(urls).count() == 2


def test_csv_variants(spark, tmp_path):
    (tmp_path / "reply.csv").write_text("siret,q,result_score,latitude\n1,x,0.9,48.5\n2,y,[ND],\n")
    got = tables.read_csv(spark, str(tmp_path / "reply.csv"), schema="siret string, q string, result_score double, latitude double", null_value="[ND]", columns=["siret", "result_score"])
    assert rows(got) == [("1", 0.9), ("2", None)]
    (tmp_path / "latin.csv").write_bytes("nom;prix\nété;3\n".encode("ISO-8859-1"))
    got = tables.read_csv_texts(spark, str(tmp_path / "latin.csv"), columns=["prix", "nom"], separator=";", encoding="ISO-8859-1")
    assert rows(got) == [("3", "été")]


def test_missing_files_are_told_from_empty_ones(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "some.json").write_text("{}")
    paths = [str(tmp_path / n) for n in ("empty.json", "some.json", "absent.json")]
    assert list(tables.file_sizes(spark, paths).values()) == [0, 2, None]


def test_empty_and_corrupt_tables_add_nothing(spark, frame, tmp_path):
    frame("a int", (1,)).write.parquet(str(tmp_path / "full"))
    frame("a int", (1,)).where("a > 1").write.parquet(str(tmp_path / "empty"))
    broken = tmp_path / "broken.parquet"
    broken.write_bytes(b"PAR1 cut off")
    assert tables.read_parquet(spark, str(tmp_path / "full"), str(tmp_path / "empty")).count() == 1
    assert tables.read_parquet(spark, str(tmp_path / "full"), str(broken), schema="a int").count() == 1


def test_scan_reads_only_the_columns_it_needs(spark, frame, tmp_path):
    frame("a int, b int, c string", (1, 2, "x")).write.parquet(str(tmp_path / "t"))
    plan = tables.read_parquet(spark, str(tmp_path / "t"), columns=["a"]).where("a > 0")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:int>" in plan and "GreaterThan(a,0)" in plan


def test_large_documents_give_the_records_of_small_ones(spark, tmp_path):
    def record(i, layout):
        held = [{"typeIdentifiant": "SIRET", "id": f"}}{i}{{"}]
        return {
            "id": f"{i}", "objet": f'a "quoted" }} {{ [ ] \\\\ {i} é', "acheteur": {"id": f"b{i}"}, "modifications": [{"modification": {"montant": i}}],
            "titulaires": held if layout == "2019" else [{"titulaire": h} for h in held],
        }

    texts = {
        "old.json": {"meta": {"marches": [{"id": "no"}], "x": [[{"id": "no"}]]}, "marches": [record(i, "2019") for i in range(120)] + [None], "more": [{"id": "no"}, {"marches": [{"id": "no"}]}]},
        "new.json": {"a": "}", "marches": {"version": {"marche": [{"id": "no"}]}, "marche": [record(i, "2022") for i in range(120)], "other": [{"id": "no"}]}, "z": {"marche": [{"id": "no"}]}},
        "empty.json": {"marches": []},
        "stranger.json": {"contracts": [{"id": "no"}]},
    }
    for name, document in texts.items():
        text = json.dumps(document, ensure_ascii=False, indent=1 if name == "new.json" else None)
        (tmp_path / name).write_text(("\ufeff" if name != "empty.json" else "") + text + ("\n" if name != "old.json" else ""))
    (tmp_path / "spoilt.json").write_text('{"marches": [{"id": "1"}, {"id": nix}, {"id": "3", "x": {"y": NaN,"z": 1}}]}')
    (tmp_path / "stopped.json").write_text('{"marches": [{"id": "1"}, {"id": "2"')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    try:
        small, files = large_json.read_large_documents(spark, str(tmp_path))
        name = F.element_at(F.split("path", "/"), -1)
        found = {(r.f, r.layout, r.whole) for r in files.select(name.alias("f"), "layout", "whole").collect()}
        assert found == {
            ("old.json", "2019", True), ("new.json", "2022", True), ("empty.json", "2019", True), ("stranger.json", None, True),
            ("spoilt.json", "2019", True), ("stopped.json", "2019", False),
        }
        small = small.join(files.select("path", "layout"), "path")
        bad = small.where("not readable").select(name.alias("f"), "payload").collect()
        assert [(r.f, "nix" in r.payload) for r in bad] == [("spoilt.json", True)]
        for file, layout in (("old.json", "2019"), ("new.json", "2022"), ("spoilt.json", "2019")):
            got = documents.flatten(documents.records(small.where(name == file).drop("readable"), layout), layout).drop("path")
            whole = documents.read_payloads(spark, str(tmp_path / file)).withColumn("payload", repair.json_text(F.col("payload")))
            if file == "spoilt.json":
                assert sorted(values(got, "id")) == ["1", "3"]
            else:
                want = documents.flatten(documents.records(whole.withColumn("layout", F.lit(layout)), layout), layout).drop("path")
                assert want.count() == 240 and rows(got) == rows(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_pieces_of_large_documents_stay_where_they_are_for_the_ends_of_files(spark, tmp_path, monkeypatch):
    (tmp_path / "one.json").write_text('{"marches": [{"id": "1"}, {"id": "}2"}]}\n')
    plans, placed = [], large_json.placed
    monkeypatch.setattr(large_json, "placed", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or placed(df, *a))
    small, files = large_json.read_large_documents(spark, str(tmp_path))
    found = documents.records(small.where("readable").drop("readable").join(files.select("path", "layout"), "path"), "2019")
    assert "strategy=broadcast" in plans[0] and sorted(values(found, "id")) == ["1", "}2"]


def test_records_of_a_chunk_are_one_document_wherever_chunks_end(spark, tmp_path, monkeypatch):
    held = [{"titulaire": {"typeIdentifiant": "SIRET", "id": "}{"}}]
    records = [{"id": f"{i}", "objet": f'a "b" \\ }} [ {i}', "acheteur": {"id": "b"} if i % 7 else "text", "titulaires": held} for i in range(80)]
    odd = [None, 5, "}", [{"id": "no"}], {}]
    lists = {
        "plain": {"marches": records}, "mixed": {"marches": [*odd, *records[:20], *odd, *records[20:]]}, "inner": {"marches": {"version": {}, "marche": records, "x": odd}},
        "ends": {"x": [1], "marches": {"marche": records[:3]}, "more": [{"marches": [{"id": "no"}]}]}, "nothing": {"marches": {"marche": []}},
    }
    for name, document in lists.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(document, indent=1 if name == "mixed" else None) + ("\n" if name == "inner" else ""))
    # A record that can't be read stops no other, though it stands between records that are read together.
    (tmp_path / "spoilt.json").write_text('{"marches":[' + ",".join(f'{{"id":"{i}"}}' if i != 40 else '{"id":nix}' for i in range(80)) + "]}")
    name, found = F.regexp_extract("path", r"(\w+)\.json", 1), {}
    for step in (1, 64, 512):
        monkeypatch.setattr(large_json, "_STEP", step)
        small, files = large_json.read_large_documents(spark, str(tmp_path))
        joined = materialise(small.join(files.select("path", "layout"), "path").withColumn("path", name), "small")
        assert joined.where("not readable").select("path").collect() == [("spoilt",)]
        flat = [documents.flatten(documents.records(joined.where("readable").drop("readable"), n), n).select("path", "id", "objet", "acheteur_id", "titulaires") for n in ("2019", "2022")]
        found[step] = joined.where("path = 'plain'").count(), rows(flat[0]) + rows(flat[1]), rows(files.select(name.alias("path"), "layout", "whole"))
    assert found[1][1:] == found[64][1:] == found[512][1:] and found[64][0] < 40 < 80 <= found[1][0]
    ids = [r[:2] for r in found[512][1]]
    assert all(sorted(i for f, i in ids if f == x and i) == sorted(f"{k}" for k in range(80)) for x in ("plain", "mixed", "inner"))
    assert sorted(i for f, i in ids if f == "spoilt") == sorted(f"{k}" for k in range(80) if k != 40) and sum(f == "ends" for f, _ in ids) == 3


def test_files_are_looked_at_side_by_side():
    class System:
        def exists(self, place):
            time.sleep(0.05)
            return not place.name.startswith("no")

        def getContentSummary(self, place):  # noqa: N802
            return SimpleNamespace(getLength=lambda: len(place.name))

    def place(name):
        return SimpleNamespace(name=name, getFileSystem=lambda conf: System())

    jvm = SimpleNamespace(org=SimpleNamespace(apache=SimpleNamespace(hadoop=SimpleNamespace(fs=SimpleNamespace(Path=place)))))
    fake = SimpleNamespace(_jsc=SimpleNamespace(hadoopConfiguration=lambda: None), _jvm=jvm)
    paths = [f"{'no' if i % 3 == 0 else 'a'}{i}" for i in range(64)]
    began = time.monotonic()
    sizes = tables.file_sizes(fake, paths)
    assert time.monotonic() - began < 64 * 0.05 / 2
    assert list(sizes) == paths and all(sizes[p] == (None if p.startswith("no") else len(p)) for p in paths)


def test_links_in_comments_scripts_and_styles_are_none(frame):
    page = (
        '<!-- <a href="/old">x</a> --><script type="t">var a = \'<a href="/made">\';</script><STYLE>a[href="/s"]{}</STYLE >'
        '<a href="/one">1</a><scripted href="/two"/><A HREF=\'/three\'>3</A><!-- never closed <a href="/four">'
    )
    assert sorted(values(pages.all_links(frame("html string", (page,), (None,), ("",))), "link")) == ["/one", "/three", "/two"]


def test_entities_are_decoded_once(frame):
    texts = {
        "/caf&#233;&#xE9;&#X1F600;": "/caf\u00e9\u00e9\U0001f600",
        "/a?b=1&amp;c=2&#38;d&#x26;e": "/a?b=1&c=2&d&e",
        "/&amp;lt;&amp;#233;&#38;amp;": "/&lt;&#233;&amp;",
        "/&#0;&#xD800;&#9999999;&nbsp;": "/&#0;&#xD800;&#9999999;&nbsp;",
        "/&lt;&quot;&apos;&#39;": "/<\"''",
    }
    df = frame("k string", *[(k,) for k in texts])
    assert dict(rows(df.select("k", pages.unescaped(pages.F.col("k")).alias("v")))) == texts
