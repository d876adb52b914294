import re

from ledgerlens.llm import licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
MIT = licenses.NOTICES[6][0]
ROWS = [
    (1, None),
    (2, ""),
    (3, "Under the GNU General Public License, version 3. gnu general public-license"),
    (4, "cc by cc by CC-BY cc"),
    (5, "MIT"),
    (6, "the MIT\nLicense and the apache license"),
    (7, MIT.replace("granted", "given").title()),
    (8, MIT.replace("to any person", "now to every single person")),
    (9, " ".join(reversed(MIT.split()))),
    (10, "Licensed under CC BY-NC 4.0."),
    (11, "é gnu général public license"),
    (12, ("word " * 3000) + "mit license " + ("cc by " * 2000)),
    (6, "the MIT\nLicense and the apache license"),
    (None, "cc by"),
    (13, "mit. x license"),
]


def _scan(spark, rows=ROWS):
    df = spark.createDataFrame([(k, t, 1, "c") for k, t in rows], "doc_id long, text string, template int, spans string")
    return licenses.scan(df.repartition(3)).collect()


def _base(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_phrases_match_brute_force(spark):
    found = sorted(((r.key, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in _scan(spark)), key=repr)
    assert found == sorted(((k, *_base(t)) for k, t in ROWS), key=repr)


def test_notices_may_differ_in_some_words(spark):
    found = {r.key: r for r in _scan(spark)}
    assert found[7].labels == "mit" and 0.9 < found[7].score < 1
    assert found[8].labels == "mit" and 0.8 <= found[8].score < 1
    assert found[9].labels == "" and found[9].score == 0
    assert found[10].labels == "cc-by,cc-by-nc" and found[10].score == 1
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in found.values())


def test_notices_with_changed_words_reach_the_verification(spark):
    mit = MIT.split()
    rows = [
        (1, "licensed under the apache licence version 2 0"),
        (2, "gnu lesser general public licence"),
        (3, "gnu affero general public licence"),
        (4, "licensed under CC-BY-NC version 4.0".replace("version 4", "v 4")),
        (5, "x " + " ".join([*mit[:4], "a", *mit[5:9], "b", *mit[10:]]) + " y"),
        (6, "licensed below cc by nc 4 0"),
        (7, "gnu general public license"),
        (8, "gnu lesser general public license"),
        (9, "licensed under cc by sa 4 0, licensed under cc by 4 0"),
        (10, "licensed under the other license version 2 0"),
    ]
    found = {r.key: (r.labels, round(r.score, 3)) for r in _scan(spark, rows)}
    assert found == {
        1: ("apache", 0.875), 2: ("lgpl", 0.8), 3: ("agpl", 0.8), 4: ("cc-by,cc-by-nc", 1.0), 5: ("mit", 0.875),
        6: ("cc-by,cc-by-nc", 1.0), 7: ("gpl", 1.0), 8: ("lgpl", 1.0), 9: ("cc-by", 1.0), 10: ("", 0.0),
    }


def test_template_of_more_than_64_words(spark, monkeypatch):
    long = " ".join(f"word{i}" for i in range(300))
    monkeypatch.setattr(licenses, "NOTICES", [*licenses.NOTICES, (long, "long")])
    changed = long.replace("word150 ", "other ")
    assert [(r.labels, round(r.score, 3)) for r in _scan(spark, [(1, changed)])] == [("long", 0.997)]


def test_shuffled_lookup_gives_the_same(spark, monkeypatch):
    wanted = sorted(map(repr, _scan(spark)))
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", 0)
    assert sorted(map(repr, _scan(spark))) == wanted


def test_empty_table(spark):
    assert _scan(spark, []) == []
