"""The registered queries of this subpackage, over the tables of one folder, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    decontaminate,
    exact_dup,
    labelled,
    language,
    licenses,
    near_dup,
    ngram_join,
    pii,
    prefix_trie,
    quality,
    repair,
    secrets,
    toxicity,
)

#: Key of the registered query's surrogates; a user passes a secret one.
SURROGATE_KEY = b"registered query"

#: Least similarity of near duplicates by the contract of op6.
NEAR_DUPLICATES = (85, 100)

#: Least similarity of linked documents by the contract of op13.
NGRAM_LINKS = (90, 100)

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path() -> str:
    """The byte-level vocabulary file that every machine has."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    return secrets.digest(found).withColumnRenamed("key", "doc_id")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents")).drop("spans").withColumnRenamed("key", "doc_id")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select(F.col("key").alias("doc_id"), "n_words", "n_hit", "n_items", digest, "contaminated", "n_near")


def _held_out(parts: int, which: int):
    return F.coalesce(labelled.remainder(F.col("doc_id"), parts) == which, F.lit(False))


def _predicted():
    return F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, "toxic", ~_held_out(4, 2))
    scored = toxicity.score(docs, model).withColumnRenamed("key", "doc_id")
    return scored.select("doc_id", _held_out(4, 2).alias("held_out"), "score", _predicted())


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(_table(spark, sf_dir, "documents"), vocabulary_path())


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_classes(_table(spark, sf_dir, "documents"), threshold=NEAR_DUPLICATES)
    return found.select(F.col("key").alias("doc_id"), "n_shingles", F.col("component_key").alias("component_id"), "kept")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = pii.replace(_table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return replaced.withColumnRenamed("key", "doc_id")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.fit(docs, "lang", ~_held_out(4, 2))
    found = language.predict(docs, model).withColumnRenamed("key", "doc_id")
    return found.select("doc_id", _held_out(4, 2).alias("held_out"), F.col("language").alias("lang_pred"), "score")


def quality_model(spark: SparkSession, sf_dir: str) -> dict:
    """Learned from the labelled rows of the folder that are not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.fit(docs, labels, "quality", ~_held_out(5, 0))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(spark, sf_dir)).withColumnRenamed("key", "doc_id")
    return scored.select("doc_id", _held_out(5, 0).alias("held_out"), "score", _predicted())


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dup.groups(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), F.col("keep_key").alias("keep_id"), "group_size", "kept", "text_sha256"
    )


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    found = repair.digest(turns.select(F.col("conv_id").alias("conv")), repair.damage(turns))
    return found.withColumnRenamed("conv", "conv_id")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string")) % 4
    found = prefix_trie.trie(_table(spark, sf_dir, "conversations"), conv - conv % 20, head)
    return found.withColumnsRenamed({"conv": "conv_id", "parent_conv": "parent_conv_id"}).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.join_classes(_table(spark, sf_dir, "documents"), threshold=NGRAM_LINKS)
    return found.select(F.col("key").alias("doc_id"), "n_shingles", F.col("component_key").alias("component_id"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op3_decontaminate": f"""
        with docs as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
        items as (select cast(item_id as varchar) as item, {_WORDS} as w from benchmark),
        sized as (select item, w, least(13, len(w)) as n from items where len(w) > 0),
        windows as (
            select distinct item, n, array_to_string(w[i:i + n - 1], ' ') as gram
            from (select item, w, n, unnest(range(1, len(w) - n + 2)) as i from sized)),
        places as (
            select rid, n, i, array_to_string(w[i:i + n - 1], ' ') as gram
            from (select rid, w, n, unnest(range(1, len(w) - n + 2)) as i
                  from docs, (select distinct n from windows) where len(w) >= n)),
        found as (select rid, i, p.n, item from places p join windows using (n, gram)),
        hit as (select rid, count(distinct word) as n_hit from (select rid, unnest(range(i, i + n)) as word from found)
                group by rid),
        told as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as listed
                 from (select distinct rid, item from found) group by rid),
        -- proximity: places of a window's rarest word with all its other words at most 26 words away
        words as (select rid, w[i] as word, i from (select rid, w, unnest(range(1, len(w) + 1)) as i from docs)),
        often as (select word, count(*) as often from words group by word),
        parts as (select distinct item, gram, unnest(string_split(gram, ' ')) as word from windows),
        counted as (select item, gram, count(*) as n, count(often) = count(*) as whole,
                           arg_min(word, (often, word)) as rarest
                    from parts left join often using (word) group by item, gram),
        anchors as (select c.item, c.gram, c.n, w.rid, w.i from counted c join words w on w.word = c.rarest where c.whole),
        close as (select a.item, a.gram, a.rid, a.i from anchors a join parts p using (item, gram)
                  join words w on w.rid = a.rid and w.word = p.word and abs(w.i - a.i) <= 26
                  group by a.item, a.gram, a.rid, a.i, a.n having count(distinct p.word) = a.n),
        near as (select rid, count(distinct item) as n_near from close group by rid)
        select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(listed, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated, coalesce(n_near, 0) as n_near
        from docs left join hit using (rid) left join told using (rid) left join near using (rid)
    """,
    "op6_near_dedup": rf"""
        with recursive docs as (
            select row_number() over () as rid, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w
            from documents),
        shingles as (
            select distinct rid, array_to_string(w[i:i + 4], ' ') as s
            from (select rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from docs where len(w) > 0)),
        sizes as (select rid, count(*) as n from shingles group by rid),
        shared as (select a.rid as a, b.rid as b, count(*) as n
                   from shingles a join shingles b on a.s = b.s and a.rid < b.rid group by 1, 2),
        links as (select s.a, s.b from shared s join sizes x on x.rid = s.a join sizes y on y.rid = s.b
                  where 100 * s.n >= 85 * (x.n + y.n - s.n)),
        reach as (
            select rid as a, rid as b from docs
            union select r.a, l.b from reach r join (select a, b from links union all select b, a from links) l on l.a = r.b),
        least as (select r.a as rid, min(d.doc_id) as component_id from reach r join docs d on d.rid = r.b group by r.a)
        select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
        from docs join least using (rid) left join sizes using (rid)
    """,
    "op10_exact_dedup": """
        select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
               doc_id = max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
        from documents window w as (partition by coalesce(text, ''))
    """,
}

def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string as DuckDB SQL, which has no function for it."""
    chars = f"list_transform(string_split({text}, ''), lambda c: cast(ord(c) as bigint))"
    step = "list_reduce(list_concat([xor(crc, byte)], cast(range(8) as bigint[])), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {chars}), lambda crc, byte: {step}), 4294967295)"


_BLANK = r"[\x20\x09-\x0D]"

ORACLES["op11_repair"] = rf"""
    with recursive rows_ as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               {_crc32("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as kind
        from conversations),
    damaged as (
        select conv_id, turn, case when kind = 4 then 'user' else role end as role,
               case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
        from rows_, (values (0), (1)) copies(copy) where kind <> 0 and (copy = 0 or kind = 3)),
    placed as (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged),
    marked as (
        select *, regexp_replace(text, '{_BLANK}+$', '') as trimmed,
               row_number() over (partition by conv_id, role, text order by i) > 1 as again, substr(role, 1, 1) as initial
        from placed),
    faulty as (
        select *, case when trimmed = '' then 'blank' when again then 'duplicate'
                       when substr(trimmed, -1) not in ('.', '!', '?') then 'truncated' else 'none' end as fault
        from marked),
    told as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
               count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
               count(*) filter (where fault = 'truncated') as truncated
        from faulty group by conv_id),
    wrong as (
        select conv_id, count(*) filter (where follows is not null and initial || follows not in ('su', 'ua', 'au')) as illegal
        from (select conv_id, initial, lead(initial) over (partition by conv_id order by i) as follows from faulty)
        group by conv_id),
    -- states: 0 nothing yet, 1 system, 2 user, 3 assistant
    keep(state, letter, target) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
    expected(state, target, name) as (values (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
    inserts as (
        select state, 0 as price, '' as letters, cast([] as varchar[]) as lines, state as target from expected
        union all select state, 3, 'I', [name || ':'], target from expected
        union all select a.state, 6, 'II', [a.name || ':', b.name || ':'], b.target
        from expected a join expected b on b.state = a.target),
    paths as (
        select conv_id, cast(0 as bigint) as i, target as state, cast(price as bigint) as cost, letters as audit, lines
        from (select distinct conv_id from faulty), inserts where state = 0
        union all
        select conv_id, i, state, cost, audit, lines from (
            select *, row_number() over (partition by conv_id, state order by cost, audit) as best from (
                select m.conv_id, m.i, k.target as state, m.cost + k.price as cost, m.audit || k.letters as audit,
                       list_concat(m.lines, k.lines) as lines
                from (
                    select p.conv_id, r.i, p.state, p.cost + 4 as cost, p.audit || 'D' as audit, p.lines
                    from paths p join faulty r on r.conv_id is not distinct from p.conv_id and r.i = p.i + 1
                    union all
                    select p.conv_id, r.i, k.target, p.cost + if(r.fault = 'truncated', 3, 0), p.audit || 'K',
                           list_append(p.lines, r.role || ':' || r.text)
                    from paths p join faulty r on r.conv_id is not distinct from p.conv_id and r.i = p.i + 1
                    join keep k on k.state = p.state and k.letter = r.initial
                    where r.fault not in ('blank', 'duplicate')
                    union all
                    select p.conv_id, r.i, e.target, p.cost + 3 + if(r.fault = 'truncated', 3, 0), p.audit || 'R',
                           list_append(p.lines, e.name || ':' || r.text)
                    from paths p join faulty r on r.conv_id is not distinct from p.conv_id and r.i = p.i + 1
                    join expected e on e.state = p.state
                    where r.fault not in ('blank', 'duplicate')
                ) m join inserts k on k.state = m.state))
        where best = 1),
    ended as (
        select * from (
            select p.*, row_number() over (partition by p.conv_id order by p.cost, p.audit) as best
            from paths p join (select conv_id, max(i) as n from faulty group by conv_id) z
              on z.conv_id is not distinct from p.conv_id and z.n = p.i
            where p.state in (0, 3))
        where best = 1)
    select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
           coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost,
           coalesce(audit, '') as audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) as repaired_sha256
    from (select distinct conv_id from conversations) o
    left join told t on t.conv_id is not distinct from o.conv_id
    left join wrong w on w.conv_id is not distinct from o.conv_id
    left join ended e on e.conv_id is not distinct from o.conv_id
"""

ORACLES["op12_prefix_trie"] = rf"""
    with own as (
        select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                             order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
        from conversations where conv_id is not null group by conv_id),
    plans as (select *, {_crc32("cast(conv_id as varchar)")} % 4 as h from own),
    rebuilt as (
        select p.conv_id, list_concat(coalesce(b.turns[1:p.h], []), p.turns[p.h + 1:]) as turns
        from plans p left join own b on b.conv_id = p.conv_id - p.conv_id % 20),
    members as (
        select conv_id, d, turns[1:d] as prefix, len(turns) = d as ends
        from (select conv_id, turns, unnest(range(0, len(turns) + 1)) as d from rebuilt)),
    nodes as (
        select d, prefix, min(conv_id) as conv_id, count(*) as n,
               (count(*) - 1) * case when d = 0 then 0
                   else len(regexp_extract_all(prefix[d].text, '[^ 	-
]+')) end as saved,
               coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ends), '') as listed
        from members group by d, prefix),
    children as (select p.d, p.prefix, count(*) as n from nodes p join nodes c on c.d = p.d + 1 and c.prefix[1:p.d] = p.prefix
                 group by p.d, p.prefix),
    counted as (select n.*, coalesce(c.n, 0) as n_children from nodes n left join children c using (d, prefix)),
    below as (
        select a.d, a.prefix, count(*) filter (where b.n_children = 0) as n_leaves, sum(b.saved) as saved_tokens
        from counted a join counted b on b.d >= a.d and b.prefix[1:a.d] = a.prefix group by a.d, a.prefix)
    select c.conv_id, c.d as depth, p.conv_id as parent_conv_id, c.n as n_convs, c.n_children, b.n_leaves,
           cast(b.saved_tokens as bigint) as saved_tokens, sha256(c.listed) as ends_sha256
    from counted c join below b using (d, prefix) left join nodes p on p.d = c.d - 1 and p.prefix = c.prefix[1:c.d - 1]
"""

ORACLES["op13_ngram_join"] = rf"""
    with recursive docs as (
        select row_number() over () as rid, doc_id, regexp_extract_all({_LOWER}, '[^ 	-
]+') as w from documents),
    grams as (
        select distinct rid, array_to_string(w[i:i + 2], ' ') as s
        from (select rid, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from docs where len(w) > 0)),
    sizes as (select rid, count(*) as n from grams group by rid),
    shared as (select a.rid as a, b.rid as b, count(*) as n
               from grams a join grams b on a.s = b.s and a.rid < b.rid group by 1, 2),
    links as (select s.a, s.b from shared s join sizes x on x.rid = s.a join sizes y on y.rid = s.b
              where 100 * s.n >= 90 * (x.n + y.n - s.n)),
    reach as (
        select rid as a, rid as b from docs
        union select r.a, l.b from reach r join (select a, b from links union all select b, a from links) l on l.a = r.b),
    least as (select r.a as rid, min(d.doc_id) as component_id from reach r join docs d on d.rid = r.b group by r.a)
    select doc_id, coalesce(n, 0) as n_shingles, component_id
    from docs join least using (rid) left join sizes using (rid)
"""


def all_queries() -> dict[str, Query]:
    return {
        "op1_secrets": op1_secrets,
        "op2_licenses": op2_licenses,
        "op3_decontaminate": op3_decontaminate,
        "op4_toxicity": op4_toxicity,
        "op5_bpe": op5_bpe,
        "op6_near_dedup": op6_near_dedup,
        "op7_pii": op7_pii,
        "op8_language": op8_language,
        "op9_quality": op9_quality,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_repair": op11_repair,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_ngram_join": op13_ngram_join,
    }


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
