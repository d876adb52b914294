"""Secrets in texts by linking their parts: DataFrame functions only.

Strong parts (assignments, access key ids, long hex) are reported wherever they stand. Weak parts (account names,
opaque tokens, endpoints) are common in clean texts and are reported only where the complementary parts of a credential
start within ``SCOPE`` characters: a name needs a secret, a token needs an identifier, an endpoint needs both.

The interval join meets each weak part with a summary of its own, the last and the next stretch of ``SCOPE``
characters: the first and last start of each role there. So the work is linear in the number of parts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SCOPE = 200
IDENTIFIER, SECRET, ENDPOINT = "identifier", "secret", "endpoint"


@dataclass(frozen=True)
class Kind:
    """A kind of part: matches of ``pattern`` (leftmost, not overlapping) whose ``group`` has ``least`` characters."""

    name: str
    role: str
    pattern: str
    group: int = 0
    least: int = 1
    weak: bool = False


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
# What is reported, in the order in which spans with one start are listed.
KINDS = [
    Kind("assign", SECRET, f"({_either_case('password|passwd|secret|token|api_?key')}){_VALUE}([A-Za-z0-9+/_.=-]+)", 2, 6),
    Kind("access", IDENTIFIER, "AKIA[A-Z0-9]+", 0, 20),
    Kind("hex", SECRET, "[0-9a-f]{24,}", 0, 24),
    Kind("account", IDENTIFIER, f"({_either_case('username|user|login|account|client_?id')}){_VALUE}([A-Za-z0-9_.@-]+)", 2, 3, True),
    Kind(
        "opaque",
        SECRET,
        "(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[A-Z0-9+/]*[a-z])(?=[a-z0-9+/]*[A-Z])[A-Za-z0-9+/]{32,}",
        0,
        32,
        True,
    ),
    Kind(
        "endpoint",
        ENDPOINT,
        r"(?:[a-z][a-z0-9+]{1,15}://[A-Za-z0-9][A-Za-z0-9.:-]*|(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]))",
        0,
        7,
        True,
    ),
]


def _lengths(texts: Column) -> Column:
    return F.transform(texts, lambda t: F.length(t))


def _matches(text: Column, kind: Kind) -> Column:
    """For each match: the characters between it and the one before, its own number, and that of its group."""
    pattern = F.lit(kind.pattern)
    found = _lengths(F.regexp_extract_all(text, pattern, F.lit(0)))
    group = _lengths(F.regexp_extract_all(text, pattern, F.lit(kind.group))) if kind.group else found
    return F.arrays_zip(_lengths(F.split(text, kind.pattern, -1)).alias("gap"), found.alias("size"), group.alias("inner"))


def parts(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """All parts (row, kind number, first, last), and the rows they belong to (row, key). Characters are code points."""
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = [_matches(F.col("text"), kind).alias(kind.name) for kind in KINDS]
    scanned = df.select(F.col(key).alias("key"), plain.alias("text"))
    scanned = scanned.select(F.monotonically_increasing_id().alias("row"), "key", *found)
    # the piece behind the last match is no match
    some = [F.filter(kind.name, lambda m: m["size"].isNotNull()).alias(kind.name) for kind in KINDS]
    scanned = materialize(scanned.select("row", "key", *some), "secret-matches")
    out = None
    for number, kind in enumerate(KINDS):
        each = scanned.where(F.size(kind.name) > 0).select("row", F.posexplode(kind.name).alias("at", "m"))
        before = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        end = F.sum(F.col("m.gap") + F.col("m.size")).over(before)
        each = each.select("row", F.lit(number).alias("kind"), (end - F.col("m.size")).alias("first"), end.alias("last"), "m.inner")
        each = each.where(F.col("inner") >= kind.least).drop("inner")
        out = each if out is None else out.unionByName(each)
    return materialize(out, "secret-parts"), scanned.select("row", "key")


def _roles(which: Column, role: str) -> Column:
    return which.isin([i for i, kind in enumerate(KINDS) if kind.role == role])


def linked(found: DataFrame) -> DataFrame:
    """The weak parts whose complementary parts start within ``SCOPE`` characters."""
    stretch = F.floor(F.col("first") / SCOPE)
    summary = found.groupBy("row", stretch.alias("stretch")).agg(
        *[f(F.when(_roles(F.col("kind"), role), F.col("first"))).alias(f"{role}_{name}")
          for role in (IDENTIFIER, SECRET) for name, f in (("low", F.min), ("high", F.max))]
    )
    weak = found.where(F.col("kind").isin([i for i, kind in enumerate(KINDS) if kind.weak]))
    asked = weak.select("*", F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("stretch"))
    near = lambda role: (
        (F.col(f"{role}_high") >= F.col("first") - SCOPE) & (F.col(f"{role}_low") <= F.col("first") + SCOPE)
    )
    met = asked.join(materialize(summary, "secret-scopes"), ["row", "stretch"]).groupBy("row", "kind", "first", "last")
    met = met.agg(*[F.coalesce(F.bool_or(near(role)), F.lit(False)).alias(role) for role in (IDENTIFIER, SECRET)])
    kind = F.col("kind")
    needed = (
        F.when(_roles(kind, IDENTIFIER), F.col(SECRET))
        .when(_roles(kind, SECRET), F.col(IDENTIFIER))
        .otherwise(F.col(IDENTIFIER) & F.col(SECRET))
    )
    return met.where(needed).select("row", "kind", "first", "last")


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, spans (array of kind, first, last, weak; by start, then kind as listed).

    Null and empty texts have no spans. A stretch holds at most ``SCOPE`` starts of a kind, so no join key is hot.
    """
    found, rows = parts(df, key, text)
    strong = found.where(~F.col("kind").isin([i for i, kind in enumerate(KINDS) if kind.weak]))
    every = strong.unionByName(linked(found))
    spans = every.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("first", "kind", "last"))).alias("spans"))
    names, weak = F.array(*[F.lit(k.name) for k in KINDS]), F.array(*[F.lit(k.weak) for k in KINDS])
    named = F.transform(
        F.coalesce("spans", F.array().cast("array<struct<first:bigint,kind:int,last:bigint>>")),
        lambda s: F.struct(names[s["kind"]].alias("kind"), s["first"].alias("first"), s["last"].alias("last"), weak[s["kind"]].alias("weak")),
    )
    return rows.join(materialize(spans, "secret-spans"), "row", "left").select("key", named.alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """key, n_assign, n_access, n_hex, base_sha256, spans, n_weak of ``scan``'s rows; a span reads kind:start:end."""
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["last"].cast("string"))), ","
    )
    count = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")
    return scanned.select(
        "key",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(written(F.filter("spans", lambda s: ~s["weak"])), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["weak"])).cast("long").alias("n_weak"),
    )
