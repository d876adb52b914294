import pytest

from ledgerlens.llm import pii

KEY = b"test"
ROWS = [
    (1, "Mail Jo.Doe7@Mail5.Example.com or call +1 (484) 555-2842, card 4111 1111 1111 1111."),
    (2, "jo.doe7@mail5.example.com and +14845552842 again; 4111-1111-1111-1111; ssn 123-45-6789 ip 10.20.30.40 v1.2.3.4.5"),
    (3, "Mr. John Smith met Mrs Anna SMITH. Later Mr Smith left. Госпожа Анна Петрова, Κύριος Νίκος Παππάς."),
    (4, None),
    (5, ""),
    (6, "no data: 12:30, 999.999.999.999, 1234, @home, a@b, 5 + 5"),
    (7, "é\U0001f600 x@y.org" + " w" * 5000 + " z@y.org"),
    (2, "jo.doe7@mail5.example.com and +14845552842 again; 4111-1111-1111-1111; ssn 123-45-6789 ip 10.20.30.40 v1.2.3.4.5"),
    (None, "x@y.org"),
]


def _replaced(spark, rows=ROWS, secret=KEY):
    df = spark.createDataFrame([(k, t, 1, "c") for k, t in rows], "doc_id long, text string, first int, kind string")
    return pii.replace(df.repartition(3), secret).collect()


def _mentions(original, row):
    return [(e.split(":")[0], original[int(e.split(":")[1]) : int(e.split(":")[2])]) for e in filter(None, row.entities.split(","))]


def test_types_formats_and_coreference(spark):
    found = {r.key: r for r in _replaced(spark)}
    assert len(_replaced(spark)) == len(ROWS)
    texts = dict(ROWS)
    assert _mentions(texts[1], found[1]) == [("email", "Jo.Doe7@Mail5.Example.com"), ("phone", "+1 (484) 555-2842"), ("card", "4111 1111 1111 1111")]
    assert [k for k, _ in _mentions(texts[2], found[2])] == ["email", "phone", "card", "ssn", "ip"]
    first, second = found[1].text, found[2].text
    mail = first.split()[1]
    assert mail.lower() == second.split()[0] and mail != "Jo.Doe7@Mail5.Example.com"
    assert [c.isupper() for c in mail] == [c.isupper() for c in "Jo.Doe7@Mail5.Example.com"]
    digits = lambda t: "".join(c for c in t if c.isdigit())
    phone = first[first.index("+1 (") :][:17]
    assert phone.startswith("+1 (") and digits(phone) in second
    card = first[first.index("card ") + 5 :][:19]
    assert card[4] == card[9] == " " and pii.luhn(digits(card)) and card[0] == "4"
    assert card.replace(" ", "-") in second
    assert "v1.2.3.4.5" in second


def test_names_keep_gender_script_and_coreference(spark):
    text = {r.key: r for r in _replaced(spark)}[3].text
    words = text.replace(".", "").replace(",", "").split()
    john, smith, anna, smith_upper = words[1], words[2], words[5], words[6]
    assert smith_upper == smith.upper() and words[9] == smith
    assert john.endswith(tuple(pii.SYLLABLES["LATIN"][2])) and anna.endswith(tuple(pii.SYLLABLES["LATIN"][1]))
    female = words[words.index("Госпожа") + 1]
    assert female.lower().endswith(tuple(pii.SYLLABLES["CYRILLIC"][1])) and female[0].isupper()
    assert words[words.index("Κύριος") + 1].lower().endswith(tuple(pii.SYLLABLES["GREEK"][2]))
    assert "Smith" not in text and "Анна" not in text


def test_national_phones_ipv6_iban_and_untitled_mentions(spark):
    rows = [
        (1, "(555) 123-4567, 555-123-4567; fe80::1ff:fe23:4567:890a IBAN DE89 3704 0044 0532 0130 00 NOW"),
        (2, "Ms Ada Lovelace wrote. Lovelace's notes, LOVELACE and Ada; Byron stays."),
        (3, "Mr John Smith and Dr John Smith at 12:30:45, a::b, x::1"),
    ]
    found = {r.key: r for r in _replaced(spark, rows)}
    texts = dict(rows)
    assert _mentions(texts[1], found[1]) == [
        ("phone", "(555) 123-4567"), ("phone", "555-123-4567"), ("ipv6", "fe80::1ff:fe23:4567:890a"), ("iban", "DE89 3704 0044 0532 0130 00"),
    ]
    account = found[1].text[found[1].text.index("IBAN ") + 5 :][:27]
    assert account.startswith("DE") and pii.iban_remainder(account.replace(" ", "")) == 1 and account.count(" ") == 5
    assert found[1].text[1:4] + found[1].text[6:14] == found[1].text.split(", ")[1][:3] + found[1].text.split(", ")[1][4:12]
    assert "lovelace" not in found[2].text.lower() and "Ada" not in found[2].text and "Byron stays." in found[2].text
    words = found[3].text.split()
    assert words[1:3] == words[5:7] and "12:30:45, a::b, x::1" in found[3].text


def test_clean_null_and_long_texts(spark):
    found = {r.key: r for r in _replaced(spark)}
    assert found[4].text is None and found[5].text == "" and found[4].n_entities == 0
    assert found[6].text == dict(ROWS)[6] and found[6].n_entities == 0
    assert found[7].n_entities == 2 and len(found[7].text) == len(dict(ROWS)[7])
    assert found[None].text == found[7].text.split()[1]


def test_collisions_are_drawn_again(spark, monkeypatch):
    """With a tiny space of draws every surrogate collides at first."""
    plain = pii.surrogate
    monkeypatch.setattr(pii, "surrogate", lambda k, kind, v, attempt: f"s{len(v) % 2}" if not attempt else plain(k, kind, v, attempt))
    values = [("ssn", "1" * i) for i in range(1, 40)] + [("ssn", "s0"), ("ip", "1.1.1.1")]
    found = pii.surrogates(spark.createDataFrame(values, "kind string, value string"), KEY).collect()
    assert len({(r.kind, r.surrogate) for r in found}) == len(values)
    assert not {(r.kind, r.surrogate) for r in found} & set(values)


@pytest.mark.parametrize("kind, value", [("phone", "+14845552842"), ("card", "4111111111111111"), ("ssn", "123456789"), ("ip", "1.2.3.4")])
def test_other_keys_give_other_surrogates(kind, value):
    assert pii.surrogate(b"a", kind, value, 0) == pii.surrogate(b"a", kind, value, 0) != pii.surrogate(b"b", kind, value, 0)


def test_shuffled_lookup_and_empty_table(spark, monkeypatch):
    wanted = sorted(map(repr, _replaced(spark)))
    monkeypatch.setattr(pii, "BROADCAST_ROWS", 0)
    assert sorted(map(repr, _replaced(spark))) == wanted
    assert _replaced(spark, []) == []
