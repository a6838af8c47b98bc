import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from adjudica.functions import geo, nested, rules, text, typing


def apply(frame, function, *inputs):
    """Values of a column function over one text column."""
    df = frame("i int, v string", *[(i, v) for i, v in enumerate(inputs)])
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "function, given, expected",
    [
        (text.tidy_id, ["id.1", "id/2", r"a,b\c d", None], ["id_1", "id_2", "a_b_c_d", None]),
        (text.blank_to_null, ["", "x", None], [None, "x", None]),
        (lambda c: text.before(c, "+"), ["2023-01-01+02:00", "2023-01-01", "", None], ["2023-01-01", "2023-01-01", "", None]),
        (text.product_code, ["45233140-2", "033", "98765432101", " ", "", None], ["45233140", "03300000", "98765432", " 0000000", "00000000", None]),
        (lambda c: text.pad_left(c, 5), ["1053", "123456", "", None], ["01053", "123456", "00000", None]),
        (text.strip, ["   33487372600239", "a b\t", " x", None], ["33487372600239", "a b", "x", None]),
        (text.typographic_apostrophes, ["l'eau de l'île", "rue 'Haute'", "1'2", "''"], ["l’eau de l’île", "rue 'Haute'", "1’2", "''"]),
        (text.without_control_characters, ["\x02", "voirie\x1f nord\x0b", "ligne\r\n\tfin", "é\x08"], ["", "voirie nord", "ligne\r\n\tfin", "é"]),
        (text.not_communicated_to_null, ["NC", "NC ", "nc"], [None, "NC ", "nc"]),
        (
            lambda c: text.replace_words(c, text.NATURE_SPELLING),
            ["Marche subsequent", "Marche", "Autre", ""],
            ["Marché subséquent", "Marché", "Autre", ""],
        ),
    ],
)
def test_text(frame, function, given, expected):
    assert apply(frame, function, *given) == expected


def test_longest_word_is_replaced_first(frame):
    from adjudica.plans.cleaning import DATE_REPAIRS

    given = ["September, 16 2021 00:00:00", "16 2021 00:00:00", "0002-11-30", "2023-01-01", "0222-04-29"]
    expected = ["2021-09-16", "", "", "2023-01-01", "2022-04-29"]
    assert apply(frame, lambda c: text.replace_words(c, DATE_REPAIRS), *given) == expected


def test_composite_key_is_null_with_a_null_part_and_splits_again(frame):
    df = frame("a string, b string", ("x", "y"), ("x", None))
    made = df.select(text.composite(F.col("a"), F.col("b")).alias("k"))
    assert [r.k for r in made.collect()] == ["x__y", None]
    parts = made.where("k is not null").select(*[text.composite_part(F.col("k"), i) for i in (0, 1, 2)]).first()
    assert tuple(parts) == ("x", "y", None)


@pytest.mark.parametrize(
    "parts, expected",
    [(("10", "bis", "RUE", "DE LA PAIX"), "10 bis RUE DE LA PAIX"), ((None, None, "AVENUE", "DES CHAMPS"), "AVENUE DES CHAMPS")],
)
def test_address_line(frame, parts, expected):
    df = frame("a string, b string, c string, d string", parts)
    assert df.select(text.address_line(*[F.col(c) for c in "abcd"])).first()[0] == expected


@pytest.mark.parametrize(
    "function, given, expected",
    [
        (typing.whole_number, ["12", "11.0", "99999", "NC", " 11 ", "-3", None], [12, None, None, None, None, -3, None]),
        (typing.decimal_number, ["100.50", "1.0E17", "invalid", "1.0d", " 2", ".5", "3."], [100.5, 1e17, None, None, None, 0.5, 3.0]),
        (typing.flag_word, ["true", "Oui", "1", "FALSE", "non", "0", "invalid", None], [True, True, True, False, False, False, None, None]),
        (
            typing.iso_date,
            ["2023-01-01", "invalid-date", "2023", "2023-01-01T00:00", "2023-02-30", None],
            [date(2023, 1, 1), None, None, None, None, None],
        ),
        (
            typing.plausible_amount,
            ["1000", "1000000000000.00", "1.0E17", "99999999999.99", "100000000000", "on demand only", None],
            ["1000", "12311111111", "12311111111", "99999999999.99", "12311111111", "12311111111", None],
        ),
    ],
)
def test_typing(frame, function, given, expected):
    assert apply(frame, function, *given) == expected


def test_dates_after_the_reference_date_are_dropped(frame):
    df = frame("d date", (date(2024, 1, 1),), (date(2024, 1, 2),), (None,))
    assert [r[0] for r in df.select(typing.not_after(F.col("d"), date(2024, 1, 1))).collect()] == [date(2024, 1, 1), None, None]


@pytest.mark.parametrize(
    "start, months, expected",
    [
        (date(2024, 1, 1), 12, 10.2),  # 366 days: ends 2025-01-01, 305 days after 2024-03-02
        (date(2020, 1, 1), 12, 0.0),
        (date(2024, 3, 2), 1, 1.0),
        (date(2024, 6, 1), 1, 1.0),  # starts later: capped at the duration
        (None, 12, None),
        (date(2024, 1, 1), None, None),
    ],
)
def test_remaining_months(frame, start, months, expected):
    df = frame("s date, m short", (start, months))
    assert df.select(typing.remaining_months(F.col("s"), F.col("m"), date(2024, 3, 2))).first()[0] == expected


def test_haversine(frame):
    df = frame("a double, b double, c double, d double", (48.8566, 2.3522, 45.764, 4.8357), (0.0, 0.0, 0.0, 0.0), (None, 0.0, 0.0, 0.0))
    # The same distance by the spherical law of cosines.
    a, b, c, d = map(math.radians, (48.8566, 2.3522, 45.764, 4.8357))
    expected = round(6371.0 * math.acos(math.sin(a) * math.sin(c) + math.cos(a) * math.cos(c) * math.cos(d - b)))
    assert [r[0] for r in df.select(geo.whole_km(*[F.col(c) for c in "abcd"])).collect()] == [expected, 0, None]


def test_contract_type(frame):
    given = ["1581791-1", "4587554-2", "4876655-5", "618765-3", "4976", "99", "00", "ab", None]
    expected = ["Fournitures", "Travaux", "Fournitures", "Services"] + ["Non catégorisé"] * 5
    assert apply(frame, rules.contract_type, *given) == expected


@pytest.mark.parametrize(
    "form, buyer, expected",
    [
        ("7112", "11", "État"),
        ("4110", "11", "EPIC"),
        ("7312", "11", "Commune"),
        ("7346", "11", "Groupement de communes"),
        ("7354", "11", "Syndicat mixte"),
        ("7220", "11", "Département"),
        ("7230", "11", "Région"),
        ("7364", "11", "Établissement hospitalier"),
        ("5499", "11", None),
        ("7230", "217500016001", "Commune"),  # replaces a category that is there
        ("7225", "200076958000", "Département outre-mer"),  # does not
        (None, "200076958000", "Région"),
    ],
)
def test_buyer_category(frame, form, buyer, expected):
    df = frame("f string, b string", (form, buyer))
    assert df.select(rules.buyer_category(F.col("f"), F.col("b"))).first()[0] == expected


def test_site_name_in_parentheses(frame):
    df = frame("n string, s string", ("Org", "Site"), ("Org", "Org"), ("Org", None), (None, "Site"))
    assert [r[0] for r in df.select(rules.with_site_name(F.col("n"), F.col("s"))).collect()] == ["Org (Site)", "Org", "Org", None]


HOLDER = '{"typeIdentifiant":"SIRET","id":"%s","other":1}'


@pytest.mark.parametrize(
    "given, expected",
    [
        (f"[{HOLDER % 1}]", ["1"]),
        (f"[[{HOLDER % 1}]]", ["1"]),
        (f" [ [[[{HOLDER % 1}, {HOLDER % 2}]]] ]", ["1", "2"]),
        ("[" * 12 + HOLDER % 1 + "]" * 12, ["1"]),
        (f"[[{HOLDER % 1}],[{HOLDER % 2}]]", ["1"]),
        ("[]", []),
        ("[[]]", []),
        ('"string"', None),
        (None, None),
    ],
)
def test_innermost_holder_list(frame, given, expected):
    df = frame("v string", (given,))
    got = df.select(nested.parse_holders(F.col("v"), "2019").alias("h")).first().h
    assert (None if got is None else [h.id for h in got]) == expected


def test_holders_of_both_layouts(frame):
    old = frame(
        f"h {nested.HOLDERS['2019']}",
        ([{"id": "1", "typeIdentifiant": "SIRET"}, {"id": "2", "typeIdentifiant": "SIRET"}],),
        ([{"id": None, "typeIdentifiant": None}],),
        ([],),
        (None,),
    )
    got = [r.h for r in old.select(nested.tidy_holders(F.col("h"), "2019").alias("h")).collect()]
    assert [h.titulaire_id for h in got[0]] == ["1", "2"] and got[1:] == [None, None, None]
    new = frame("v string", ('[{"titulaire":{"id":"3","typeIdentifiant":"SIRET"}},{"titulaire":"id"},null]',))
    got = new.select(nested.tidy_holders(nested.parse_holders(F.col("v"), "2022"), "2022").alias("h")).first().h
    assert [tuple(h) for h in got] == [("3", "SIRET")]


@pytest.mark.parametrize(
    "given, expected",
    [
        ('[{"modification":{"montant":1.5}},{"montant":2}]', ["1.5", "2"]),
        ('{"modification":[{"montant":2},{"montant":3}]}', ["2", "3"]),
        ('{"modification":{"montant":5}}', ["5"]),
        ('{"montant":4}', ["4"]),
        ('"Sans objet"', []),
        ("[]", []),
        (None, []),
    ],
)
def test_amendment_shapes(frame, given, expected):
    df = frame("m string", (given,))
    assert [a.montant for a in df.select(nested.amendments(F.col("m")).alias("a")).first().a] == expected
