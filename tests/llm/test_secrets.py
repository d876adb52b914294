import hashlib
import re

from ledgerlens.llm import secrets

KEYWORDS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
BASE = [
    ("assign", re.compile(f"({KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
]
HEX, AKIA = "0123456789abcdef" * 2, "AKIA" + "Z" * 16
FAR = " x" * 300
ROWS = [
    (1, None),
    (2, ""),
    (3, 'PassWord = "hunter22" token:abc token: token: abcdefgh'),
    (4, f"é\U0001f600 {AKIA} then {HEX} and {HEX[:23]} AKIAAKIA{'Q' * 11} {AKIA[:19]}"),
    (5, f"api_key='{HEX}'{AKIA}"),
    (6, ("secret=" + "s" * 9 + "\n") * 400),
    (7, "user=alice" + FAR + "password: hunter22"),
    (8, "user=alice password: hunter22 at db://host.example:5432 or 10.0.0.1"),
    (9, "db://host.example:5432 alone, user=bob alone, " + "aB3" * 12),
    (10, "login: carol_1 " + "aB3" * 12),
    (11, "aB3" * 12 + FAR + "user=alice"),
    (5, f"api_key='{HEX}'{AKIA}"),
    (None, "token=abcdef"),
]


def _base(text):
    found = []
    for order, (name, pattern, group, least) in enumerate(BASE):
        found += [(m.start(), order, m.end(), name) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return [f"{name}:{a}:{b}" for a, _, b, name in sorted(found)]


def _scan(spark, rows=ROWS):
    df = spark.createDataFrame([(k, t, "clash", 1, 2) for k, t in rows], "doc_id long, text string, kind string, row int, assign int")
    return secrets.digest(secrets.scan(df.repartition(3))).collect()


def test_base_spans_match_brute_force(spark):
    found = _scan(spark)
    assert len(found) == len(ROWS)
    expected = {(k, ",".join(_base(t))) for k, t in ROWS}
    strong = [",".join(s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")) for r in found]
    assert {(r.key, s) for r, s in zip(found, strong)} == expected
    for r, s in zip(found, strong):
        assert r.base_sha256 == hashlib.sha256(s.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(s.count(f"{n}:") for n in ("assign", "access", "hex"))


def test_weak_parts_count_only_with_their_complements(spark):
    weak = {r.key: [s.split(":")[0] for s in r.spans.split(",") if s.split(":")[0] in ("account", "opaque", "endpoint")] for r in _scan(spark)}
    assert weak[7] == [] and weak[11] == []
    assert weak[8] == ["account", "endpoint", "endpoint"]
    assert weak[10] == ["account", "opaque"]
    assert weak[9] == ["endpoint", "account", "opaque"]  # the three are parts of one credential


def test_scope_is_exact(spark):
    text = lambda gap: "user=alice" + " " * gap + "password=hunter22"
    rows = [(i, "é" * shift + text(gap)) for i, (shift, gap) in enumerate([(0, 190), (0, 191), (7, 190), (7, 191), (195, 190), (199, 191)])]
    found = {r.key: r.n_weak for r in _scan(spark, rows)}
    assert found == {0: 1, 1: 0, 2: 1, 3: 0, 4: 1, 5: 0}


def test_empty_table(spark):
    assert _scan(spark, []) == []
