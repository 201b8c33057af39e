"""Secrets in texts, judged by how many owners across the corpus share the same value.

Candidates are found by pattern with their code-point offsets, all in JVM expressions: the matches and the text
between them give the positions.  One aggregate over the corpus then counts, for the hash of each value, the
distinct owners and repositories that hold it.  A value held by several owners is a copied example; a value of
one owner looks live.  Long mixed strings that no pattern names are reported only when they look live.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import fresh, stored, whole_text
from tablewright.llm.registry import query, table
from tablewright.naming import quote

# The kinds, in order, with their pattern, the group that holds the value and its least length.
KINDS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # of a run of these letters all is taken or nothing, so the length can stand here
}
# The kind the method adds: long runs that mix digits, capitals and small letters.
OPAQUE = r"[A-Za-z0-9+/_=-]{32,}"
# Owners, each with a text of its own, from which on training text keeps a value.
WIDELY = 5
SALTS = 8


SPAN = "struct<start:bigint,kind:string,end:bigint,value:string>"
STEP = 256  # elements that are summed at a time, so that long arrays are not copied whole for each
BLOCK = 4096  # characters; positions in long texts are counted from the block they are in


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _before(values: Column, fold: Callable[[Column, Column], Column], start: int) -> Column:
    """For each element of an array of bigint what ``fold`` makes of ``start`` and those before it.

    ``fold`` is a sum or a maximum; stretches are folded first, then the elements of each.
    """
    zero = F.lit(start).cast("bigint")

    def within(part: Column, begin: Column) -> Column:
        return F.aggregate(
            part, F.struct(F.array().cast("array<bigint>").alias("at"), begin.alias("now")),
            lambda acc, x: F.struct(F.concat(acc["at"], F.array(acc["now"])).alias("at"), fold(acc["now"], x).alias("now")))["at"]

    def whole(v: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(v) - 1) / STEP).cast("int"))
        parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(v, i * STEP + 1, STEP))
        return _let(parts, lambda p: F.flatten(F.zip_with(
            p, within(F.transform(p, lambda x: F.aggregate(x, zero, fold)), zero), within)))
    return _let(values, whole)


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _most(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _found(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of (start, kind, end, value) of the leftmost non-overlapping matches that are long enough.

    Starts come from summing the lengths of matches and of the pieces between them.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole

    def spans(m: Column) -> Column:
        sizes = F.zip_with(F.slice(m["gaps"], F.lit(1), F.size(m["whole"])), m["whole"], lambda g, w: F.struct(
            F.length(g).cast("bigint").alias("gap"), F.length(w).cast("bigint").alias("size")))
        return _let(sizes, lambda s: F.filter(F.transform(
            F.arrays_zip(_before(F.transform(s, lambda x: x["gap"] + x["size"]), _plus, 0).alias("b"), s.alias("s"), m["value"].alias("v")),
            lambda x: F.struct((x["b"] + x["s"]["gap"]).alias("start"), F.lit(kind).alias("kind"),
                               (x["b"] + x["s"]["gap"] + x["s"]["size"]).alias("end"), x["v"].alias("value"))),
            lambda x: F.length(x["value"]) >= least))
    found = _let(F.struct(whole.alias("whole"), value.alias("value"), F.split(text, pattern, -1).alias("gaps")), spans)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _apart(base: Column, added: Column) -> Column:
    """``base`` and those of ``added`` that overlap none of it: in the order of their starts, no end before a span lies
    beyond its start and no start after it before its end."""
    far = 1 << 62

    def kept(spans: Column) -> Column:
        named = lambda x: x["kind"] != "opaque"
        ends = _before(F.transform(spans, lambda x: F.when(named(x), x["end"]).otherwise(F.lit(-1).cast("bigint"))), _most, -1)
        starts = F.reverse(_before(F.reverse(F.transform(spans, lambda x: F.when(named(x), -x["start"]).otherwise(F.lit(-far)))), _most, -far))
        return F.transform(F.filter(F.arrays_zip(spans.alias("x"), ends.alias("e"), starts.alias("s")), lambda z: named(z["x"]) | (
            (z["e"] <= z["x"]["start"]) & (-z["s"] >= z["x"]["end"]))), lambda z: z["x"])
    both = (F.size(base) > 0) & (F.size(added) > 0)
    return F.when(both, _let(F.array_sort(F.concat(base, added)), kept)).otherwise(F.concat(base, added))


def candidate_spans(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """One marker row per document (``kind`` null) and one row per span: doc, fp, owner, repo, start, kind, end, hash.

    ``fp`` (md5 of the text) keeps documents apart that repeat an id.
    """
    text = F.col("_text")
    rows = docs.select(F.col(id_col).alias("doc"), whole_text(text_col).alias("_text"),
                       F.col(owner_col).cast("string").alias("owner"), F.col(repo_col).cast("string").alias("repo"))
    rows = rows.select("doc", "owner", "repo", F.md5("_text").alias("fp"),
                       *[_found(text, k, *v).alias(k) for k, v in KINDS.items()],
                       _found(text, "opaque", OPAQUE, 0, 32).alias("opaque"))
    mixed = F.filter("opaque", lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[A-Z]") & x["value"].rlike("[a-z]"))
    rows = rows.select("doc", "fp", "owner", "repo", F.concat(*KINDS).alias("base"), mixed.alias("mixed"))
    marker = F.array(F.lit(None).cast(SPAN))
    rows = rows.select("doc", "fp", "owner", "repo", F.explode(F.concat(marker, _apart(F.col("base"), F.col("mixed")))).alias("x"))
    return rows.select("doc", "fp", "owner", "repo", "x.start", "x.kind", "x.end",
                       F.when(F.col("x").isNotNull(), F.md5("x.value")).alias("hash"))


def ownership(spans: DataFrame, by_text: bool = False) -> DataFrame:
    """hash, owners, repos: how many distinct owners and (owner, repository) pairs hold each value.

    Pairs are made distinct before they are counted, so a value copied into a third of all documents arrives as a
    few rows.  A null owner or repository counts as one of its own.  ``by_text``: equal texts are one text, of the
    smallest of their pairs, so mirrors of a text do not add owners.
    """
    pairs = spans.filter("hash is not null").select(
        "hash", "fp", F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repo", F.lit("")).alias("repo"))
    if by_text:
        pairs = pairs.groupBy("hash", "fp").agg(F.min(F.struct("owner", "repo")).alias("x")).select("hash", "x.owner", "x.repo")
    pairs = pairs.select("hash", "owner", "repo").distinct()
    return (pairs.groupBy("hash", "owner").agg(F.count("*").alias("n"))
            .groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repos")))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_col: str = "lang", widely: int = 2, by_text: bool = False) -> DataFrame:
    """One row per input row: doc, fp, spans (array of start, kind, end, owners, repos, live), in order.

    ``live``: fewer than ``widely`` owners hold the value, counted as ``ownership`` says.  Repositories are counted
    within owners, so there are never fewer of them and a bound on them would add nothing.  Base kinds are always listed, opaque runs only if live.
    Null and empty texts have no spans; rows that repeat (id, text) give equal results, once per row; documents of
    one id and different texts are kept apart; an empty table gives an empty result.  Other columns are not read.
    """
    spans = stored(candidate_spans(docs, id_col, text_col, owner_col, repo_col), "secret-spans")
    counts = ownership(spans, by_text).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = (spans.filter("hash is not null").withColumn("salt", F.pmod(F.xxhash64("doc", "start"), F.lit(SALTS)))
             .join(counts, ["hash", "salt"]))
    found = found.select("doc", "fp", F.struct(
        "start", F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "opaque")]), F.col("kind")).alias("order"),
        "end", "kind", "owners", "repos", (F.col("owners") < widely).alias("live")).alias("span"), F.lit(0).alias("row"))
    found = found.filter((F.col("span.kind") != "opaque") | F.col("span.live"))
    rows = spans.filter("kind is null").select("doc", "fp", F.lit(None).cast(found.schema["span"].dataType).alias("span"),
                                               F.lit(1).alias("row")).unionByName(found)
    # Equal rows find equal spans: the set holds them once, and the sum of markers says how many rows there were.
    grouped = rows.groupBy("doc", "fp").agg(F.sum("row").alias("copies"), F.array_sort(F.collect_set("span")).alias("spans"))
    return (grouped.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("doc", "fp", "spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with every live-looking secret in ``text_col`` replaced by ``[secret]``; copied examples stay.

    All columns and rows are kept; texts without a live secret, null texts included, are unchanged.  Overlapping
    spans are replaced as one.  Owners are counted over distinct texts unless ``options`` say otherwise.
    """
    doc, fp, spans = (fresh(docs, name) for name in ("doc", "fp", "spans"))
    live = scan(docs, id_col=id_col, text_col=text_col, **{"by_text": True, **options}).select(
        F.col("doc").alias(doc), F.col("fp").alias(fp), F.filter("spans", lambda x: x["live"]).alias(spans)).filter(F.size(spans) > 0).distinct()
    same = F.col(id_col).eqNullSafe(F.col(doc)) & (F.md5(whole_text(text_col)) == F.col(fp))
    cleaned = F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(_replaced(F.col(text_col), F.col(spans)))
    return docs.join(live, same, "left").withColumn(text_col, cleaned).select(*[F.col(quote(c)) for c in docs.columns])


def _replaced(text: Column, spans: Column) -> Column:
    """The text with ``[secret]`` for each run of overlapping spans, which come in the order of their starts."""
    size = F.length(text).cast("bigint")

    def part(blocks: Column, begin: Column, end: Column) -> Column:
        def cut(i: Column) -> Column:
            first = F.greatest(begin - i * BLOCK, F.lit(0)).cast("int")
            return F.get(blocks, i.cast("int")).substr(first + 1, F.least(end - i * BLOCK, F.lit(BLOCK)).cast("int") - first)
        numbers = F.sequence(F.floor(begin / BLOCK).cast("bigint"), F.floor((end - 1) / BLOCK).cast("bigint"))
        return F.when(end > begin, F.array_join(F.transform(numbers, cut), "")).otherwise("")

    def joined(blocks: Column) -> Column:
        ends = F.transform(spans, lambda x: x["end"])
        pieces = F.transform(F.arrays_zip(spans.alias("x"), _before(ends, _most, 0).alias("at")), lambda z: F.when(
            z["x"]["start"] >= z["at"], F.concat(part(blocks, z["at"], z["x"]["start"]), F.lit("[secret]"))).otherwise(""))
        return F.concat(F.array_join(pieces, ""), part(blocks, F.array_max(ends), size))
    return _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), joined)


def _parts(kind: str, pattern: str, group: int, least: int) -> str:
    value = f"regexp_extract_all(text, '{pattern}', {group})"
    return f"""
    select rn, '{kind}' as kind, m, v, i,
           sum(length(g) + length(m)) over (partition by rn order by i) - length(m) as start
    from (select rn, unnest(regexp_extract_all(text, '{pattern}')) as m, unnest({value}) as v,
                 unnest(list_slice(regexp_split_to_array(text, '{pattern}'), 1,
                                   len(regexp_extract_all(text, '{pattern}')))) as g,
                 unnest(range(len(regexp_extract_all(text, '{pattern}')))) as i
          from d where regexp_matches(text, '{pattern}'))
    qualify length(v) >= {least}"""


def _sql() -> str:
    anycase = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in (
        "password", "passwd", "secret", "token", "api_?key"))
    assign = KINDS["assign"][0].replace("(?i:password|passwd|secret|token|api_?key)", f"(?:{anycase})").replace("'", "''")
    kinds = [_parts("assign", assign, 1, 6), _parts("access", KINDS["access"][0], 0, 20),
             _parts("hex", KINDS["hex"][0], 0, 24), _parts("opaque", OPAQUE, 0, 32)]
    order = "list_position(['assign', 'access', 'hex', 'opaque'], kind)"
    one = "kind || ':' || start || ':' || (start + length(m))"
    return f"""
with d as (select row_number() over () as rn, doc_id, coalesce(text, '') as text, coalesce(source, '') as owner,
                  coalesce(lang, '') as repo from documents),
found as ({" union all ".join(f"select * from ({k})" for k in kinds)}),
cand as (select f.*, d.owner, d.repo from found f join d using (rn)
         where kind <> 'opaque' or (regexp_matches(v, '[0-9]') and regexp_matches(v, '[A-Z]') and regexp_matches(v, '[a-z]')
               and not exists (select 1 from found b where b.rn = f.rn and b.kind <> 'opaque'
                               and b.start < f.start + length(f.m) and f.start < b.start + length(b.m)))),
owned as (select v, count(distinct owner) as owners from cand group by v),
kept as (select c.*, owners < 2 as live, {order} as k from cand c join owned using (v) where kind <> 'opaque' or owners < 2),
per as (select rn, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
               count(*) filter (kind = 'hex') as n_hex, count(*) filter (live) as n_live,
               string_agg({one}, ',' order by start, k) filter (kind <> 'opaque') as base,
               string_agg({one}, ',' order by start, k) as spans from kept group by rn)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live
from d left join per using (rn)
"""


@query("op4_secret_scans", _sql())
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint")
    return found.select(
        F.col("doc").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.filter("spans", lambda x: x["kind"] != "opaque")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: x["live"])).cast("bigint").alias("n_live"))
