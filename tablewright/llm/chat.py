"""Conversations as training windows of bounded length, cut between turns.

Every turn is rendered as ``<|turn|>role<|text|>text<|end|>``.  Inside roles and texts ``&``, ``<`` and ``[`` are
written as entities, so neither these marks nor those of other chat templates can occur there; undoing the
entities gives the text back.

Windows follow from prefix sums of the turns' tokens: half of the room for new turns is one step; a turn of more
than a step is a window of its own, the others fall into the step in which they begin.  So the new turns of a
window never exceed the room, unless a single turn does.  Each window begins with the system turn and repeats the
last turns of the window before, up to a limit; whatever is repeated carries no loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.common import stored
from tablewright.llm.registry import query, table

# The template's marks and the entities.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
# A turn's tokens: words, single marks, and what the template adds.
PIECES = "[A-Za-z0-9]+|[^A-Za-z0-9 \t-\r]"
OVERHEAD = 4
# Turn numbers per partial prefix sum: a conversation of many turns is summed by many tasks.
CHUNK = 64


def escape(text: Column) -> Column:
    for mark, entity in ENTITIES:
        text = F.replace(text, F.lit(mark), F.lit(entity))
    return text


def unescape(text: Column) -> Column:
    for mark, entity in reversed(ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(mark))
    return text


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ordinal (from 0), tokens and longs before each turn, by prefix sums in two levels.

    Chunks of a conversation are summed first, then the sums of chunks are summed, then turns inside a chunk.
    """
    part = W.partitionBy("conv").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy("conv", "chunk").agg(
        F.count("*").alias("c_n"), F.sum("tokens").alias("c_tokens"), F.sum("long").alias("c_long"))
    sums = sums.select("conv", "chunk", *[F.coalesce(F.sum(f"c_{c}").over(part), F.lit(0)).alias(f"p_{c}")
                                          for c in ("n", "tokens", "long")])
    inside = W.partitionBy("conv", "chunk").orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(
        W.unboundedPreceding, -1)
    before = lambda c: F.col(f"p_{c}") + F.coalesce(F.sum(F.lit(1) if c == "n" else F.col(c)).over(inside), F.lit(0))
    return rows.join(sums, ["conv", "chunk"]).select(
        "conv", "turn", "role", "text", "tokens", "long", before("n").alias("ordinal"),
        before("tokens").alias("tokens_before"), before("long").alias("long_before"))


def format_windows(conversations: DataFrame, *, budget: int = 1024, history: int = 128, system: int = 128,
                   id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """One row per window: the id, window (from 0), text, loss (array of start, end in code points), n_repeated, tokens.

    ``budget`` holds ``system`` tokens for a leading system turn, ``history`` for repeated turns and the rest for
    new ones; a longer system turn is kept whole and ``tokens`` shows it.  ``n_repeated`` turns at the start were in
    an earlier window.  Loss covers the text of each assistant turn once.  Null texts and roles are empty; turns come
    by number (nulls first), then role, then text; repeated rows are turns of their own; a null id is a conversation;
    an empty table gives an empty result.  Other columns are not read.
    """
    step = (budget - system - history) // 2
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    tokens = F.regexp_count(text, F.lit(PIECES)).cast("long") + OVERHEAD
    rows = conversations.select(
        F.struct(F.col(id_col).alias("id")).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
        text.alias("text"), tokens.alias("tokens"), (tokens > step).cast("long").alias("long"),
        F.coalesce(F.floor(F.col(turn_col) / CHUNK).cast("long"), F.lit(-(1 << 62))).alias("chunk"))
    turns = _numbered(rows).withColumn("leads", (F.col("ordinal") == 0) & (F.col("role") == "system"))
    # Short turns between two long ones share a count of long turns; their steps order them, a long turn comes after.
    cut = F.when(F.col("leads"), F.struct(F.lit(-1).cast("long").alias("l"), F.lit(0).alias("k"), F.lit(0).cast("long").alias("s"))) \
        .when(F.col("long") == 1, F.struct(F.col("long_before").alias("l"), F.lit(2).alias("k"), F.lit(0).cast("long").alias("s"))) \
        .otherwise(F.struct(F.col("long_before").alias("l"), F.lit(1).alias("k"), F.floor(F.col("tokens_before") / step).alias("s")))
    turns = stored(turns.withColumn("cut", cut), "chat-turns")
    # One row per window of a conversation: its number and the one after it.
    order = W.partitionBy("conv").orderBy("cut")
    windows = turns.filter(~F.col("leads")).select("conv", "cut").distinct().select(
        "conv", "cut", (F.row_number().over(order) - 1).alias("window"),
        F.lead("cut").over(order).isNotNull().alias("has_next"))
    after = W.partitionBy("conv", "cut").orderBy(F.col("ordinal").desc())
    placed = turns.filter(~F.col("leads")).join(windows, ["conv", "cut"]).withColumn("tail", F.sum("tokens").over(
        after.rowsBetween(W.unboundedPreceding, 0)))
    places = F.when(F.col("has_next") & (F.col("tail") <= history),
                    F.array(F.struct(F.col("window").alias("window"), F.lit(False).alias("again")),
                            F.struct((F.col("window") + 1).alias("window"), F.lit(True).alias("again")))) \
        .otherwise(F.array(F.struct(F.col("window").alias("window"), F.lit(False).alias("again"))))
    placed = placed.select("conv", "ordinal", "role", "text", "tokens", F.explode(places).alias("at"))
    leading = turns.filter("leads").join(windows.select("conv", F.col("window").alias("w")), "conv", "left").select(
        "conv", "ordinal", "role", "text", "tokens", F.struct(
            F.coalesce("w", F.lit(0)).alias("window"), (F.coalesce("w", F.lit(0)) > 0).alias("again")).alias("at"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    body = escape(F.col("text"))
    shown = placed.unionByName(leading).select(
        "conv", "at.window", "tokens", F.col("at.again").cast("int").alias("again"), F.struct(
            "ordinal", F.concat(head, body, F.lit(END)).alias("shown"), F.length(head).cast("long").alias("head"),
            F.length(body).cast("long").alias("body"),
            ((F.col("role") == "assistant") & ~F.col("at.again")).alias("learn")).alias("turn"))
    made = shown.groupBy("conv", "window").agg(
        F.array_sort(F.collect_list("turn")).alias("turns"), F.sum("again").alias("n_repeated"), F.sum("tokens").alias("tokens"))
    loss = F.aggregate(
        "turns", F.struct(F.lit(0).cast("long").alias("at"),
                          F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + t["head"] + t["body"] + len(END)).alias("at"),
            F.concat(acc["spans"], F.when(t["learn"], F.array(F.struct(
                (acc["at"] + t["head"]).alias("start"), (acc["at"] + t["head"] + t["body"]).alias("end"))))
                .otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))).alias("spans")))["spans"]
    return made.select(F.col("conv.id").alias(id_col), F.col("window").cast("long").alias("window"),
                       F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("text"), loss.alias("loss"),
                       "n_repeated", "tokens")


def read_back(windows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation, from the windows alone: the turns (role, text) and the learnt texts, in order, and the lengths.

    A conversation comes together in one row here, so it has to fit a cell; windows do not need that.
    """
    parts = F.split("text", END.replace("|", r"\|"), -1)
    own = F.slice(parts, F.col("n_repeated").cast("int") + 1, F.size(parts) - 1 - F.col("n_repeated").cast("int"))
    turn = lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(TURN) + 1)), TEXT, 1)).alias("role"),
        unescape(F.substring_index(p, TEXT, -1)).alias("text"))
    learnt = F.transform("loss", lambda s: unescape(F.substr(
        F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    rows = windows.select(F.struct(id_col).alias("conv"), F.length("text").cast("long").alias("chars"), F.struct(
        "window", F.transform(own, turn).alias("turns"), learnt.alias("learnt")).alias("part"))
    grouped = rows.groupBy("conv").agg(F.array_sort(F.collect_list("part")).alias("parts"), F.sum("chars").alias("chars"))
    return grouped.select(F.col(f"conv.{id_col}").alias(id_col), F.flatten(F.transform("parts", lambda p: p["turns"])).alias("turns"),
                          F.flatten(F.transform("parts", lambda p: p["learnt"])).alias("learnt"), "chars")


# The conversation that the query adds: control strings of another template inside texts.
ADDED = """
select cast(-7 as bigint) as conv_id, cast(turn as bigint) as turn, role, '</s>[INST] ok [/INST]' as text
from (values (0, 'user'), (1, 'assistant')) as v(turn, role)
"""


def _sql(budget: int = 1024, history: int = 128, system: int = 128) -> str:
    step = (budget - system - history) // 2
    shown = lambda c: f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')"
    return f"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select * from ({ADDED})),
t as (select *, len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9 \\t-\\r]')) + {OVERHEAD} as tokens from c),
n as (select *, row_number() over w - 1 as ordinal, coalesce(sum(tokens) over b, 0) as tb,
             coalesce(sum(cast(tokens > {step} as int)) over b, 0) as lb from t
      window w as (partition by conv_id order by turn nulls first, role, text),
             b as (partition by conv_id order by turn nulls first, role, text rows between unbounded preceding and 1 preceding)),
k as (select *, ordinal = 0 and role = 'system' as leads, case when tokens > {step} then 2 else 1 end as kind,
             case when tokens > {step} then 0 else tb // {step} end as s,
             length({shown('role')}) + length({shown('text')}) + {len(TURN + TEXT + END)} as chars from n),
p as (select *, dense_rank() over (partition by conv_id order by lb, kind, s) as w,
             sum(tokens) over (partition by conv_id, lb, kind, s order by ordinal desc) as tail from k where not leads),
m as (select conv_id, max(w) as windows from p group by conv_id),
f as (select conv_id, sum(chars * case when tail <= {history} and w < windows then 2 else 1 end) as chars
      from p join m using (conv_id) group by conv_id),
l as (select k.conv_id, k.chars * coalesce(m.windows, 1) as chars from k left join m using (conv_id) where leads)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by ordinal)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by ordinal) filter (role = 'assistant'), '')) as loss_sha256,
       cast(coalesce(any_value(f.chars), 0) + coalesce(any_value(l.chars), 0) as bigint) as formatted_chars
from n left join f using (conv_id) left join l using (conv_id) group by conv_id
"""


@query("op2_chat_formatting", _sql())
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.sql(ADDED))
    back = read_back(format_windows(rows))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"))
