"""Personal data replaced by keyed surrogates of the same type.

Every different value gets one surrogate for the whole corpus, so mentions that meant the same still do; a surrogate
keeps script, gender and format: lengths, letter case, separators, country codes, check digits. Surrogates are drawn
from a keyed hash of the value. A draw that equals a real value of the corpus, or the surrogate of another value, is
drawn again, so that different values stay different.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .marks import text_hash

BROADCAST_ROWS = 50_000  # texts with entities that may be looked up by a broadcast table; more are shuffled
WIDEN_AFTER = 8  # draws of one format before the format gets a character longer

EMAIL, PHONE, CARD, SSN, IP, IPV6, IBAN, FEMALE, MALE, GIVEN, SURNAME = (
    "email", "phone", "card", "ssn", "ip", "ipv6", "iban", "female", "male", "given", "surname",
)
NAMES = [FEMALE, MALE, GIVEN, SURNAME]
KINDS = [EMAIL, IBAN, PHONE, CARD, SSN, IP, IPV6, *NAMES]

# Titles that stand before a name, with the gender that they tell.
TITLES = {
    "Mr": MALE, "Mrs": FEMALE, "Ms": FEMALE, "Miss": FEMALE, "Sir": MALE, "Dr": GIVEN, "Prof": GIVEN,
    "Herr": MALE, "Frau": FEMALE, "Monsieur": MALE, "Madame": FEMALE, "Mme": FEMALE, "Mlle": FEMALE,
    "Señor": MALE, "Señora": FEMALE, "Señorita": FEMALE, "Don": MALE, "Doña": FEMALE,
    "Господин": MALE, "Госпожа": FEMALE, "Κύριος": MALE, "Κυρία": FEMALE,
}
# Syllables of surrogate names, and the ends that mark gender, by script.
SYLLABLES = {
    "LATIN": ("ba be da do fa ga ha jo ka la le li ma me mi na no pa ra re ri ro sa se ta te ti to va vi".split(), "lia na ra".split(), "nor mil ten".split()),
    "CYRILLIC": ("ба ве да до га жа ка ла ле ли ма ме ми на но па ра ре ри ро са се та те ти то ва ви зо лу".split(), "лия на ра".split(), "нор мил тен".split()),
    "GREEK": ("βα γα δα ζα κα λα λε λι μα με μι να νο πα ρα ρε ρι ρο σα σε τα τε τι το φα φι χα χο δο κο".split(), "λια να ρα".split(), "νος μης τος".split()),
}

_LOCAL = regex.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}$")
_DOMAIN = regex.compile(r"[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}")
_NUMBERS = [
    (PHONE, regex.compile(r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)")),
    (PHONE, regex.compile(r"(?<![\w+.-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-]|\.\d)")),
    (CARD, regex.compile(r"(?<![\d.+-])\d(?:[ -]?\d){12,18}(?![\d.-]*\d)")),
    (SSN, regex.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    (IP, regex.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)")),
]
_NAME = regex.compile(r"(?<!\p{L})(" + "|".join(TITLES) + r")\.?[  ](\p{Lu}[\p{L}'’-]{1,40})(?:[  ](\p{Lu}[\p{L}'’-]{1,40}))?")
_IPV6 = regex.compile(r"(?<![\w:.])(?=[0-9A-Fa-f:]*\d)[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,8}(?![\w:])")
_IBAN = regex.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_DIGIT = regex.compile(r"[0-9]")

Entity = tuple[str, int, int, str]


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_remainder(value: str) -> int:
    """The remainder of an account number by 97; 1 if its check digits are right."""
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def _ibans(text: str) -> Iterator[Entity]:
    for m in _IBAN.finditer(text):
        written = m[0]  # capitals that follow may look like its last groups
        while len(written) >= 15:
            value = written.replace(" ", "")
            if iban_remainder(value) == 1:
                yield IBAN, m.start(), m.start() + len(written), value
                break
            written = written.rpartition(" ")[0]


def _ipv6(text: str) -> Iterator[Entity]:
    for m in _IPV6.finditer(text):
        try:
            yield IPV6, m.start(), m.end(), ipaddress.IPv6Address(m[0]).compressed
        except ValueError:
            continue


def _again(text: str, names: dict[str, str]) -> Iterator[Entity]:
    """Mentions without a title of names that the same text has behind one."""
    if not names:
        return
    listed = "|".join(map(regex.escape, sorted(names, key=len, reverse=True)))
    for m in regex.finditer(rf"(?<!\p{{L}})(?:{listed})(?!\p{{L}})", text, regex.IGNORECASE):
        if m[0][0].isupper() and m[0].lower() in names:
            yield names[m[0].lower()], m.start(), m.end(), m[0].lower()


def detect(text: str) -> list[Entity]:
    """(kind, first, last, normal value) in code points, in order, not overlapping."""
    found: list[Entity] = []
    at = text.find("@")
    while at >= 0:
        local, domain = _LOCAL.search(text, max(0, at - 64), at), _DOMAIN.match(text, at + 1)
        if local and domain:
            found.append((EMAIL, local.start(), domain.end(), text[local.start() : domain.end()].lower()))
        at = text.find("@", at + 1)
    if _DIGIT.search(text):
        for kind, pattern in _NUMBERS:
            for m in pattern.finditer(text):
                digits = "".join(c for c in m[0] if c.isdigit())
                if kind == CARD and not (luhn(digits) or (len(digits) == 16 and digits[0] in "3456")):
                    continue
                if kind == IP and any(int(part) > 255 for part in m[0].split(".")):
                    continue
                found.append((kind, m.start(), m.end(), m[0] if kind == IP else ("+" if m[0][0] == "+" else "") + digits))
        found.extend(_ibans(text))
        found.extend(_ipv6(text))
    names: dict[str, str] = {}
    for m in _NAME.finditer(text):
        found.append((TITLES[m[1]] if m[3] else SURNAME, m.start(2), m.end(2), m[2].lower()))
        if m[3]:
            found.append((SURNAME, m.start(3), m.end(3), m[3].lower()))
            names.setdefault(m[3].lower(), SURNAME)
        names.setdefault(m[2].lower(), TITLES[m[1]] if m[3] else SURNAME)
    found.extend(_again(text, names))
    out: list[Entity] = []
    for entity in sorted(found, key=lambda e: (e[1], KINDS.index(e[0]), -e[2])):
        if not out or entity[1] >= out[-1][2]:
            out.append(entity)
    return out


class _Draw:
    """Numbers from a keyed hash, one after the other."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}:{value}:{attempt}".encode(), hashlib.sha256).digest()
        self.pool, self.count = b"", 0

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hashlib.sha256(self.seed + self.count.to_bytes(4, "big")).digest()
            self.count += 1
        head, self.pool = self.pool[:4], self.pool[4:]
        return int.from_bytes(head, "big") % n


def _like(text: str, draw: _Draw) -> str:
    """A text with other letters and digits in the same places."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return "".join(letters[draw.below(26)] if c.isalpha() else str(draw.below(10)) if c.isdigit() else c for c in text)


def _script(word: str) -> str:
    name = unicodedata.name(word[0], "LATIN").split()[0]
    return name if name in SYLLABLES else "LATIN"


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The surrogate of a normal value, in normal form."""
    draw = _Draw(key, kind, value, attempt)
    extra = max(0, attempt - WIDEN_AFTER)
    if kind == EMAIL:
        local, domain = value.split("@")
        name, _, top = domain.rpartition(".")
        # one domain keeps one surrogate, so that colleagues stay colleagues
        place = _like(name, _Draw(key, "domain", domain, 0))
        return _like(local + "x" * extra, draw) + "@" + place + "." + top
    if kind in (PHONE, CARD, SSN):
        keep = 2 if kind == PHONE else 1 if kind == CARD else 0
        body = value[keep:]
        digits = [str(2 + draw.below(8)) if i == 0 else str(draw.below(10)) for i in range(len(body))]
        out = value[:keep] + "".join(digits)
        if kind == CARD and luhn(value):
            out = next(out[:-1] + c for c in "0123456789" if luhn(out[:-1] + c))
        return out
    if kind == IP:
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == IPV6:
        return ipaddress.IPv6Address(sum(draw.below(1 << 16) << (16 * i) for i in range(8))).compressed
    if kind == IBAN:
        body = value[:2] + "00" + _like(value[4:], draw).upper()
        return f"{value[:2]}{98 - iban_remainder(body):02d}{body[4:]}"
    syllables, female, male = SYLLABLES[_script(value)]
    stem = "".join(syllables[draw.below(len(syllables))] for _ in range(max(2, min(4, len(value) // 2)) + extra))
    ends = {FEMALE: female, MALE: male, GIVEN: female + male}.get(kind)
    return stem + ends[draw.below(len(ends))] if ends else stem


def dress(mention: str, kind: str, value: str) -> str:
    """A surrogate in normal form, written the way the mention was: separators and letter case."""
    if kind in (PHONE, CARD, SSN):
        digits = iter(value.lstrip("+"))
        return "".join(next(digits) if c.isdigit() else c for c in mention)
    if kind == IBAN:
        letters = iter(value)
        return "".join(c if c == " " else next(letters) for c in mention)
    if kind in (IP, IPV6):
        return value
    if mention.isupper():
        return value.upper()
    if kind == EMAIL:
        if len(mention) == len(value):
            return "".join(v.upper() if m.isupper() else v for m, v in zip(mention, value))
        return value
    return value[:1].upper() + value[1:]


def entities(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text_hash, entities) of the rows that have any; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [detect(t or "") for t in batch.column(1).to_pylist()]
            some = [i for i, e in enumerate(found) if e]
            rows = batch.take(pa.array(some, pa.int64()))
            listed = [[dict(zip(("kind", "first", "last", "value"), e)) for e in found[i]] for i in some]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("value", pa.string())]))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array(listed, kind)], ["key", "text_hash", "entities"])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), text_hash(F.col(text)))
    kind = rows.schema["key"].dataType.simpleString()
    listed = "array<struct<kind:string,first:bigint,last:bigint,value:string>>"
    return materialize(rows.mapInArrow(run, f"key {kind}, text_hash bigint, entities {listed}"), "entities")


def _drawn(values: DataFrame, secret: bytes) -> DataFrame:
    """(kind, value, attempt, surrogate) for rows (kind, value, attempt)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "value", "attempt")))
            made = pa.array([surrogate(secret, *row) for row in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], ["kind", "value", "attempt", "surrogate"])

    return values.select("kind", "value", "attempt").mapInArrow(run, "kind string, value string, attempt int, surrogate string")


def _group(kind: Column) -> Column:
    """Names of all kinds are one group: a value has one surrogate in it, and no other value has the same."""
    return F.when(kind.isin(NAMES), "name").otherwise(kind)


def _resolved(each: DataFrame) -> DataFrame:
    """(kind, value) for mentions (kind, value): one kind for each value of a group, a gender if all mentions allow it."""
    found = each.groupBy(_group(F.col("kind")).alias("group"), "value").agg(F.collect_set("kind").alias("kinds"))
    has = lambda kind: F.array_contains("kinds", kind)
    name = F.when(has(FEMALE) & has(MALE), GIVEN)
    for kind in NAMES:
        name = name.when(has(kind), kind)
    return found.select(F.when(F.col("group") == "name", name).otherwise(F.col("group")).alias("kind"), "value")


def surrogates(values: DataFrame, secret: bytes) -> DataFrame:
    """(kind, value, surrogate) for different (kind, value): different surrogates, none of them a real value."""
    group = _group(F.col("kind")).alias("group")
    real = values.select(group, F.col("value").alias("surrogate"))
    now = materialize(_drawn(values.withColumn("attempt", F.lit(0)), secret), "surrogates")
    while True:
        now = now.withColumn("group", group)
        first = now.groupBy("group", "surrogate").agg(F.min(F.struct("attempt", "value")).alias("first"))
        taken = first.join(real.withColumn("real", F.lit(True)), ["group", "surrogate"], "left")
        told = now.join(materialize(taken, "surrogate-owners"), ["group", "surrogate"])
        bad = F.coalesce("real", F.lit(False)) | (F.col("value") != F.col("first.value"))
        told = materialize(told.select("kind", "value", "attempt", "surrogate", bad.alias("bad")), "surrogate-checks")
        if not told.where("bad").limit(1).count():
            return now.select("kind", "value", "surrogate")
        again = _drawn(told.where("bad").withColumn("attempt", F.col("attempt") + 1), secret)
        now = materialize(told.where("NOT bad").drop("bad").unionByName(again), "surrogates")


def replace(df: DataFrame, secret: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_entities, entities (kind:first:last of the input text, in order), text.

    ``text`` is the whole text with surrogates, null where it was. The same ``secret`` gives the same surrogates for the
    same corpus. Repeated rows are replaced alike.
    """
    found = entities(df, key, text)
    each = found.select("key", "text_hash", F.explode("entities").alias("e")).select("key", "text_hash", "e.*")
    values = materialize(_resolved(each), "entity-values")
    made = surrogates(values, secret)
    # one value may stand in very many texts: the join splits it, and each text gathers only its own mentions
    made = made.select(_group(F.col("kind")).alias("group"), "value", "surrogate")
    named = each.withColumn("group", _group(F.col("kind"))).join(made, ["group", "value"])
    spans = named.groupBy(F.col("key").alias("found_key"), F.col("text_hash").alias("found_hash")).agg(
        F.array_sort(F.collect_set(F.struct("first", "last", "kind", "surrogate"))).alias("spans")
    )
    spans = materialize(spans, "replacements")
    if spans.count() <= BROADCAST_ROWS:
        spans = F.broadcast(spans)
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), text_hash(F.col(text)).alias("text_hash"))
    same = rows["key"].eqNullSafe(spans["found_key"]) & (rows["text_hash"] == spans["found_hash"])
    joined = rows.join(spans, same, "left").select("key", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, listed, texts = [], [], []
            for item, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                pieces, at = [], 0
                for s in spans or []:
                    pieces += [item[at : s["first"]], dress(item[s["first"] : s["last"]], s["kind"], s["surrogate"])]
                    at = s["last"]
                texts.append("".join([*pieces, item[at:]]) if spans else item)
                counts.append(len(spans or []))
                listed.append(",".join(f"{s['kind']}:{s['first']}:{s['last']}" for s in spans or []))
            columns = [pa.array(counts, pa.int64()), pa.array(listed, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["key", "n_entities", "entities", "text"])

    kind = rows.schema["key"].dataType.simpleString()
    return joined.mapInArrow(run, f"key {kind}, n_entities bigint, entities string, text string")
