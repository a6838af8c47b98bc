from datetime import date, timedelta

import pytest
from conftest import rows, values

from adjudica.plans import enrich as enriching
from adjudica.plans import geocache, monthly, registers

COMPANIES = "siren string, denominationUniteLegale string, categorieEntreprise string, categorieJuridiqueUniteLegale string"
RAW_COMPANIES = (
    "siren string, denominationUniteLegale string, prenomUsuelUniteLegale string, nomUniteLegale string, nomUsageUniteLegale string,"
    "statutDiffusionUniteLegale string, categorieEntreprise string, categorieJuridiqueUniteLegale string"
)
SITES = (
    "siret string, latitude double, longitude double, commune_code string, commune_nom string, departement_code string,"
    "departement_nom string, region_code string, region_nom string, etablissement_nom string, activite_code string, activite_nomenclature string"
)
CACHE = "siret string, latitude double, longitude double, source string, score double, geocoded_at date, status string"
TODAY = date(2026, 5, 15)


@pytest.fixture
def companies(frame):
    return frame(
        COMPANIES,
        ("123456789", "Org 1", "ETI", "5499"),
        ("123456790", "Org 2", None, "7230"),
        ("200076958", "Collectivité de Corse", None, "7229"),
    )


@pytest.fixture
def sites(frame):
    place = (11.12, 12.13, "12345", "Commune", "12", "Département", "01", "Région")
    return frame(
        SITES,
        ("12345678900022", *place, "Établissement nom", "11.11A", "NAFRev2"),
        ("12345678900023", *place, "Org", "11.11B", "NAFRev2"),
    )


def test_company_names(frame):
    """Companies have a name of their own, persons a first name and the name in use or by birth, unless they asked to be left out."""
    raw = {
        "410000001": ("Scierie du Lac", None, None, None, "O"),
        "410000002": (None, "Ada", "Nowak", None, "O"),
        "410000003": (None, "Ada", "Nowak", "Berg", "O"),
        "410000004": (None, "Ada", "Nowak", "Berg", "P"),
        "410000005": (None, "Ada", None, None, "O"),
    }
    given = [(number, *names, "PME", "1000") for number, names in raw.items()]
    got = registers.prepare_companies(frame(RAW_COMPANIES, *given, given[1], (None, "Sans numéro", None, None, None, "O", None, None)))
    assert dict(rows(got, "siren", "denominationUniteLegale")) == {
        "410000001": "Scierie du Lac",
        "410000002": "Ada Nowak",
        "410000003": "Ada Berg",
        "410000004": "[Données personnelles non-diffusibles]",
        "410000005": None,
    }
    assert got.count() == 5


def test_sites_get_codes_and_places(frame):
    geo = frame(
        "commune_code string, commune_nom string, departement_code string, region_code string, departement_nom string, region_nom string",
        ("01053", "Bourg-en-Bresse", "01", "84", "Ain", "Auvergne-Rhône-Alpes"),
    )
    raw = frame(
        "siret string, codeCommuneEtablissement string, enseigne1Etablissement string, denominationUsuelleEtablissement string,"
        "activitePrincipaleEtablissement string, nomenclatureActivitePrincipaleEtablissement string",
        ("11111111111", "1053", None, "Dénom usuelle", "11.1A", "NAFv2"),
    )
    got = registers.prepare_sites(raw, geo).first().asDict()
    assert got == {
        "siret": "00011111111111",
        "commune_code": "01053",
        "etablissement_nom": "Dénom usuelle",
        "activite_code": "11.1A",
        "activite_nomenclature": "NAFv2",
        "commune_nom": "Bourg-en-Bresse",
        "departement_code": "01",
        "region_code": "84",
        "region_nom": "Auvergne-Rhône-Alpes",
        "departement_nom": "Ain",
    }


def test_overseas_territories_are_department_and_region(frame):
    got = registers.build_geo_register(
        frame("COM string, LIBELLE string, REG string, DEP string", ("01053", "Bourg", "84", "01"), ("01054", "None", "84", "")),
        frame("COM_COMER string, LIBELLE string, COMER string", ("97501", "Miquelon", "975")),
        frame("DEP string, LIBELLE string", ("01", "Ain")),
        frame("COMER string, LIBELLE string", ("975", "Saint-Pierre")),
        frame("REG string, LIBELLE string", ("84", "Auvergne")),
    )
    assert [tuple(r) for r in got.select("commune_code", "departement_nom", "region_code", "region_nom").collect()] == [
        ("01053", "Ain", "84", "Auvergne"),
        ("97501", "Saint-Pierre", "975", "Saint-Pierre"),
    ]


def test_company_data_of_holders_and_buyers(frame):
    """Companies are found by the first nine digits; a buyer's category comes from its legal form, a holder's is its size."""
    companies = frame(
        COMPANIES, ("500000001", "Fonderie", "GE", "5710"), ("500000002", "Bretagne", None, "7230"), ("500000003", "Bourg", "PME", "7210")
    )
    parties = [f"50000000{i}000{i}7" for i in (1, 2, 3, 4)]
    holders = enriching.enrich_company(frame("titulaire_id string", *[(p,) for p in parties]), companies, "titulaire_id", "titulaire")
    assert rows(holders, "titulaire_id", "titulaire_nom", "titulaire_categorie") == [
        (parties[0], "Fonderie", "GE"), (parties[1], "Bretagne", None), (parties[2], "Bourg", "PME"),
    ]
    buyers = enriching.enrich_company(frame("acheteur_id string", *[(p,) for p in parties]), companies, "acheteur_id", "acheteur")
    assert rows(buyers, "acheteur_nom", "acheteur_categorie") == [("Bourg", "Commune"), ("Bretagne", "Région"), ("Fonderie", None)]


def test_site_data(frame, sites):
    ids = frame("org_id string, org_nom string", ("12345678900022", "Org"), ("12345678900023", "Org"))
    got = enriching.enrich_site(ids, sites, "org_id", "org")
    assert rows(got, "org_id", "org_nom", "org_latitude", "org_commune_code", "org_region_nom", "activite_code") == [
        ("12345678900022", "Org (Établissement nom)", 11.12, "12345", "Région", "11.11A"),
        ("12345678900023", "Org", 11.12, "12345", "Région", "11.11B"),
    ]


def test_enrichment_matches_site_ids_only_and_falls_back(frame, companies, sites):
    df = frame(
        "uid string, acheteur_id string, titulaire_id string, titulaire_typeIdentifiant string",
        ("1", "12345678900022", "12345678900023", "SIRET"),
        ("2", "12345678900022", "12345678900023", "TVA"),
        ("3", "13001536500013", None, None),
    )
    got = enriching.enrich(df, companies, sites)
    assert not [c for c in got.columns if c.endswith("_siren")]
    assert rows(got, "uid", "acheteur_nom", "titulaire_nom", "titulaire_distance") == [
        ("1", "Org 1 (Établissement nom)", "Org 1 (Org)", 0),
        ("2", "Org 1 (Établissement nom)", None, None),
        ("3", "Ministère des Armées", None, None),
    ]


def test_pending_leaves_out_settled_ids(frame):
    df = frame(
        "acheteur_id string, titulaire_id string",
        ("11111111111111", "33333333333333"),
        ("22222222222222", "22222222222222"),
        ("44444444444444", "55555555555555"),
        ("short", None),
    )
    cache = frame(
        CACHE,
        ("11111111111111", 48.0, 2.0, "decp", None, None, "success"),
        ("22222222222222", None, None, "geoplateforme", 0.2, TODAY - timedelta(days=5), "failed"),
        ("33333333333333", None, None, "geoplateforme", 0.1, TODAY - timedelta(days=60), "failed"),
        ("44444444444444", None, None, "geoplateforme", None, TODAY - timedelta(days=10), "not_in_sirene"),
    )
    assert rows(geocache.select_pending(df, cache, TODAY)) == [("33333333333333",), ("55555555555555",)]


ADDRESSES = (
    "siret string, numeroVoieEtablissement string, indiceRepetitionEtablissement string, typeVoieEtablissement string,"
    "libelleVoieEtablissement string, codePostalEtablissement string, commune_code string"
)


def test_cache_upsert(frame):
    cache = frame(CACHE, ("00000000000000", 48.0, 2.0, "decp", None, None, "success"), ("22222222222222", 1.0, 1.0, "decp", None, None, "failed"))
    df = frame("acheteur_id string, titulaire_id string", ("11111111111111", "22222222222222"), ("99999999999999", "99999999999999"))
    sites = frame(
        ADDRESSES,
        ("11111111111111", "10", None, "RUE", "DE LA PAIX", "75001", "75101"),
        ("22222222222222", "5", None, "AVENUE", "DE LYON", "69001", "69381"),
    )
    replies = frame(
        "siret string, result_score double, latitude double, longitude double",
        ("11111111111111", 0.92, 48.869, 2.331),
        ("22222222222222", 0.3, 45.7, 4.8),
    )
    pending = geocache.select_pending(df, cache, TODAY)
    assert rows(geocache.geocoder_request(pending, sites)) == [
        ("11111111111111", "10 RUE DE LA PAIX", "75001", "75101"),
        ("22222222222222", "5 AVENUE DE LYON", "69001", "69381"),
    ]
    got = geocache.upsert_cache(cache, pending, replies, sites, TODAY)
    assert rows(got, "siret", "status", "latitude", "score") == [
        ("00000000000000", "success", 48.0, None),
        ("11111111111111", "success", 48.869, 0.92),
        ("22222222222222", "failed", None, 0.3),
        ("99999999999999", "not_in_sirene", None, None),
    ]
    without = geocache.upsert_cache(cache, pending, None, sites, TODAY)
    assert "11111111111111" not in values(without, "siret")


def test_replies(frame):
    df = frame(
        "siret string, result_score double, latitude double, longitude double",
        ("1", 0.92, 48.869, 2.331), ("2", 0.2, 48.0, 2.0), ("3", None, None, None), ("4", 0.5, 1.0, 1.0),
    )
    parsed = geocache.parse_replies(df, TODAY)
    assert rows(parsed, "siret", "status", "latitude", "source", "geocoded_at") == [
        ("1", "success", 48.869, "geoplateforme", TODAY),
        ("2", "failed", None, "geoplateforme", TODAY),
        ("3", "failed", None, "geoplateforme", TODAY),
        ("4", "success", 1.0, "geoplateforme", TODAY),
    ]
    assert rows(geocache.reply_report(parsed)) == [("failed", 2, 50.0), ("success", 2, 50.0)]


def test_seeded_cache(frame):
    df = frame(
        "acheteur_id string, acheteur_latitude double, acheteur_longitude double, titulaire_id string, titulaire_latitude double, titulaire_longitude double",
        ("12345678901234", 48.85, 2.35, "98765432109876", 45.75, 4.85),
        (None, None, None, "98765432109876", 45.75, 4.85),
        ("00000000000000", 0.0, 0.0, None, None, None),
        ("98765432109876", 1.0, 1.0, "short", 1.0, 1.0),
    )
    got = registers.seed_cache(df)
    assert got.columns == geocache.CACHE_COLUMNS
    assert rows(got, "siret", "latitude", "source", "score", "geocoded_at", "status") == [
        ("00000000000000", 0.0, "decp", None, None, "success"),
        ("12345678901234", 48.85, "decp", None, None, "success"),
        ("98765432109876", 1.0, "decp", None, None, "success"),  # as a buyer before as a holder
    ]


def _raw(frame, name="Adour", **more):
    company = "siren string, denominationUniteLegale string, prenomUsuelUniteLegale string, nomUniteLegale string, nomUsageUniteLegale string, statutDiffusionUniteLegale string, categorieEntreprise string, categorieJuridiqueUniteLegale string"
    site = "siret string, codeCommuneEtablissement string, enseigne1Etablissement string, denominationUsuelleEtablissement string, activitePrincipaleEtablissement string, nomenclatureActivitePrincipaleEtablissement string"
    tables = dict(
        companies=frame(company, ("111", name, None, None, None, "O", "PME", "5710"), (None, "x", None, None, None, "O", "PME", "5710")),
        sites=frame(site, ("11100000000017", "1004", None, "Quay", "01.1A", "NAFRev2"), (None, "1004", None, "lost", None, None), ("222", "99999", "Shop", None, None, None)),
        communes=frame("COM string, LIBELLE string, REG string, DEP string", ("01004", "Bayonne", "75", "64")),
        overseas_communes=frame("COM_COMER string, LIBELLE string, COMER string", ("97501", "Miquelon", "975")),
        departments=frame("DEP string, LIBELLE string", ("64", "Pyrenees")),
        overseas_departments=frame("COMER string, LIBELLE string", ("975", "Saint-Pierre")),
        regions=frame("REG string, LIBELLE string", ("75", "Aquitaine")),
        coordinates=frame("siret string, latitude double, longitude double", ("11100000000017", 43.5, -1.5)),
    )
    return monthly.RawRegisters(**{**tables, **more})


def test_monthly_registers_are_one_job_that_goes_on_where_it_stopped(spark, frame, tmp_path):
    folder = str(tmp_path)
    made = monthly.refresh(spark, _raw(frame), folder, "2026-05")
    found = rows(made["sites"], "siret", "commune_nom", "departement_nom", "region_nom", "etablissement_nom", "latitude")
    assert found == [("00000000000222", None, None, None, "Shop", None), ("11100000000017", "Bayonne", "Pyrenees", "Aquitaine", "Quay", 43.5)]
    assert rows(made["geo"], "commune_code", "departement_nom") == [("01004", "Pyrenees"), ("97501", "Saint-Pierre")]
    monthly.refresh(spark, _raw(frame, "Nive"), folder, "2026-05")
    assert values(monthly.read_registers(spark, folder, "2026-05")["companies"], "denominationUniteLegale") == ["Adour"]
    (tmp_path / "companies" / "month=2026-05" / "_SUCCESS").unlink()  # as if the run had been cut off while it wrote
    monthly.refresh(spark, _raw(frame, "Nive"), folder, "2026-05")
    assert values(monthly.read_registers(spark, folder, "2026-05")["companies"], "denominationUniteLegale") == ["Nive"]
    assert values(monthly.refresh(spark, _raw(frame, "Gave"), folder, "2026-05", again=True)["companies"], "denominationUniteLegale") == ["Gave"]
    monthly.refresh(spark, _raw(frame, "Luy", coordinates=None), folder, "2026-06")
    assert "latitude" not in monthly.read_registers(spark, folder, "2026-06")["sites"].columns
    assert values(monthly.read_registers(spark, folder, "2026-05")["companies"], "denominationUniteLegale") == ["Gave"]


def test_no_site_is_written_without_places(spark, frame, tmp_path):
    none = _raw(frame, communes=frame("COM string, LIBELLE string, REG string, DEP string"), overseas_communes=frame("COM_COMER string, LIBELLE string, COMER string"))
    with pytest.raises(ValueError):
        monthly.refresh(spark, none, str(tmp_path), "2026-05")
    assert not (tmp_path / "sites").exists()
