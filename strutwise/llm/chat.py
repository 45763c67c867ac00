"""Chat formatting in budgeted windows, in DataFrame functions only.

Turns of a conversation are laid end to end by prefix sums of their tokens. A
window takes turns as long as they fit the budget beside what it repeats: the
conversation's system turn (if its first turn is one) and the last turns before
the window, up to the history allowance. The next window starts at the first
turn that doesn't fit. A turn that doesn't fit a window of its own is whole in
one, flagged ``over_budget``; history is left out before a turn is flagged.
Every turn is new in exactly one window; repeated turns are not under the loss
mask.

Starts are looked for in sections of 64 budgets of tokens: a window also
starts at the first turn at or after each multiple of that length, wherever it
lies, so sections are independent of each other and no task follows a whole
conversation. History crosses sections.

The template is ``[INST]role\\ntext[/INST]``, for the assistant
``<s>role\\ntext</s>``. Backslashes in texts are doubled and a backslash is put
inside every control string, so no text can open or close a turn and
unescaping gives back what was there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strutwise.llm.common import stored

#: Tokens of a window, and of them for history.
BUDGET, HISTORY = 1024, 128
#: Budgets in a section.
SECTION = 64
CONTROL = r"/?(?:INST\]|s>|SYS>>)"
ASSISTANT, SYSTEM = "assistant", "system"
#: What counts as one token: three ASCII letters or digits at most, any other sign but white space.
UNIT = r"[A-Za-z]{1,3}|[0-9]{1,3}|[^\x20\x09-\x0DA-Za-z0-9]"


def token_count(text: Column) -> Column:
    """Tokens of a text as a high estimate, for callers without counts of their own.

    Units, and half a token more for each byte of UTF-8 that a sign has beyond
    one: byte-level vocabularies of 50,000 tokens need one to three for a sign
    outside ASCII. An empty text has none.
    """
    return (F.regexp_count(text, F.lit(UNIT)) + F.floor((F.octet_length(text) - F.char_length(text)) / 2)).cast("long")


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), rf"([<\[])(?={CONTROL}|<SYS>>|</SYS>>)", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escaped_role(role: Column) -> Column:
    return F.regexp_replace(escaped(role), r"\n", "\\\\\n")


def parsed(formatted: Column) -> Column:
    """The turns of a formatted window: array of struct(role, text)."""
    bodies = F.regexp_extract_all(formatted, F.lit(r"(?s)(?:\[INST\]|<s>)(.*?)(?:\[/INST\]|</s>)"), F.lit(1))
    head = r"(?s)^([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n(.*)$"
    return F.transform(
        bodies,
        lambda b: F.struct(unescaped(F.regexp_extract(b, head, 1)).alias("role"), unescaped(F.regexp_extract(b, head, 2)).alias("text")),
    )


_CONV = ["__z", "__c"]


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns with ``pos`` and ``before`` (turns and tokens before them) and ``head``, the conversation's first turn.

    Rows without texts are range-sorted, so a conversation may lie in many
    partitions; sums inside a partition are moved on by those of the partitions
    before it. Only the first and the last conversation of a partition can have
    others, so the table of offsets has two rows for each partition at most.
    """
    order = [F.col("__z"), F.col("__c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("start"), F.col("like"), F.col("uid")]
    placed = stored(
        turns.select(*_CONV, "turn", "role", F.left("text", F.lit(64)).alias("start"), F.xxhash64("text").alias("like"), "uid", "tokens")
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select(*_CONV, (F.col("role") == SYSTEM).alias("system"), "uid", "tokens", F.monotonically_increasing_id().alias("place")),
        "turn-order",
    ).withColumn("part", F.shiftright("place", 33))
    own = Window.partitionBy(*_CONV, "part").orderBy("place")
    past = own.rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("pos", F.row_number().over(own) - 1).withColumn("before", F.coalesce(F.sum("tokens").over(past), F.lit(0)))
    local = local.withColumn("head", F.first(F.struct("system", "uid", "tokens")).over(own))
    parts = placed.groupBy(*_CONV, "part").agg(F.count("*").alias("n"), F.sum("tokens").alias("sum"), F.min("place").alias("place"))
    along = Window.partitionBy(*_CONV).orderBy("part")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    moved = parts.select(
        *_CONV, "part", F.count("*").over(Window.partitionBy(*_CONV)).alias("parts"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("moved"), F.first("place").over(along).alias("first"),
    ).where("parts > 1").drop("parts")
    heads = placed.select(F.col("place").alias("first"), F.struct("system", "uid", "tokens").alias("opening"))
    offsets = heads.join(F.broadcast(moved), "first").drop("first")
    return local.join(F.broadcast(offsets), [*_CONV, "part"], "left").select(
        *_CONV, "uid", "tokens", (F.col("pos") + F.coalesce("skip", F.lit(0))).alias("pos"),
        (F.col("before") + F.coalesce("moved", F.lit(0))).alias("before"), F.coalesce("opening", "head").alias("head"),
    )


def _members(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """A row for each turn of each window: ``window, k`` (its place there), ``new, uid``."""
    length = SECTION * budget
    section = F.floor(F.col("before") / F.lit(length)).cast("long")
    # the turns just before a section are history of its first windows
    near = F.col("before") >= (F.col("section") + 1) * F.lit(length) - F.lit(history)
    spread = turns.withColumn("section", section).withColumn(
        "at", F.explode(F.when(near, F.array("section", F.col("section") + 1)).otherwise(F.array("section")))
    ).withColumn("own", F.col("at") == F.col("section"))
    inside = Window.partitionBy(*_CONV, "at").orderBy("before")
    system = F.col("head.system")
    repeated = F.when(system, F.col("head.tokens")).otherwise(F.lit(0))
    if history > 0:
        prior = F.collect_list(F.when(~system | (F.col("before") > 0), F.col("before"))).over(inside.rangeBetween(-history, -1))
    else:
        prior = F.expr("cast(array() as array<bigint>)")
    allowed = F.least(F.lit(history), F.greatest(F.lit(0), F.lit(budget) - repeated - F.col("tokens")))
    numbered = spread.withColumn("k", F.row_number().over(inside)).withColumn("prior", prior).withColumn("least", F.col("before") - allowed)
    kept = F.filter("prior", lambda b: b >= F.col("least"))
    opened = numbered.withColumn("kept", kept).withColumn(
        "until",
        F.when(F.col("before") == 0, F.lit(budget)).otherwise(
            F.col("before") + F.lit(budget) - repeated - F.when(F.size("kept") > 0, F.col("before") - F.array_min("kept")).otherwise(F.lit(0))
        ),
    )
    entry = F.struct("k", "own", "pos", "uid", (F.col("before") + F.col("tokens")).alias("end"), "until", F.size("kept").alias("h"))
    sections = opened.groupBy(*_CONV, "at").agg(F.sort_array(F.collect_list(entry)).alias("turns"), F.first("head").alias("head")).where(F.element_at("turns", -1)["own"])
    found = F.aggregate(
        F.filter("turns", lambda t: t["own"]),
        F.struct(F.lit(-1).cast("long").alias("until"), F.expr("cast(array() as array<struct<k:int,h:int,pos:bigint>>)").alias("starts")),
        lambda s, t: F.when(
            t["end"] > s["until"],
            F.struct(t["until"].alias("until"), F.concat(s["starts"], F.array(F.struct(t["k"].cast("int").alias("k"), t["h"].alias("h"), t["pos"].cast("long").alias("pos")))).alias("starts")),
        ).otherwise(s),
        lambda s: s["starts"],
    )
    starts = sections.withColumn("starts", found).select(*_CONV, "turns", "head", "starts", F.posexplode("starts").alias("i", "start"))
    end = F.coalesce(F.get("starts", F.col("i") + 1)["k"], F.size("turns") + 1)
    first = F.col("start.k") - F.col("start.h")
    rows = F.transform(
        F.slice("turns", first, end - first), lambda t: F.struct(t["k"].cast("int").alias("k"), (t["k"] >= F.col("start.k")).alias("new"), t["uid"].alias("uid"))
    )
    front = F.array(F.struct(F.lit(-1).alias("k"), F.lit(False).alias("new"), F.col("head.uid").alias("uid")))
    return starts.select(
        F.col("start.pos").alias("window"),
        F.explode(F.when(F.col("head.system") & (F.col("start.pos") > 0), F.concat(front, rows)).otherwise(rows)).alias("turn"),
    ).select("window", "turn.*")


def chat_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Column | None = None) -> DataFrame:
    """One row per window: ``conv_id, window, formatted, loss_spans, n_tokens, n_repeated, over_budget``.

    ``turns`` has ``conv_id, turn, role, text``; ``tokens`` counts those of a
    text exactly, where the caller knows (else they are estimated); role, marks
    and escapes are counted on top. ``window`` is the ordinal of the first new
    turn, ``loss_spans`` are (start, length) in code points of ``formatted``,
    ``n_repeated`` counts the repeated turns in front. A null role or text
    counts as empty; a null turn number comes first; turns that tie are ordered
    by role, the first 64 code points of the text, then a hash of it; repeated
    rows are turns of their own; a null conversation id is a conversation. Only
    a system turn in first place is retained. Other columns are ignored, also
    those named like the ones used here. No turns give no rows.

    Texts are written once and shuffled twice, by row and by window.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    plain = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        (tokens if tokens is not None else F.lit(None)).cast("long").alias("given"), F.monotonically_increasing_id().alias("uid"),
    )
    piece = plain.select("*", *_piece(F.col("role"), F.col("text")), F.char_length(escaped(F.col("text"))).alias("size"))
    marks = token_count(F.concat(F.substr("piece", F.lit(1), F.col("lead")), F.lit("[/INST]"))) + F.col("size") - F.char_length("text")
    counted = F.when(F.col("given").isNull(), token_count(F.col("piece"))).otherwise(F.col("given") + marks)
    pieces = stored(
        piece.select(
            "conv_id", F.col("conv_id").isNull().alias("__z"), F.coalesce("conv_id", F.lit(0)).alias("__c"), "turn", "role", "text",
            "piece", "lead", F.when(F.col("role") == ASSISTANT, F.col("size")).alias("loss"), F.greatest(counted, F.lit(1)).alias("tokens"), "uid",
        ),
        "turns",
    )
    members = _members(_ordered(pieces), budget, history)
    part = F.struct("k", "new", "piece", "lead", F.when(F.col("new"), F.col("loss")).alias("loss"), "tokens")
    whole = members.join(pieces.select("conv_id", "uid", "piece", "lead", "loss", "tokens"), "uid").groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(part)).alias("pieces")
    )
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.char_length(p["piece"])).alias("at"),
            F.when(p["loss"].isNotNull(), F.concat(a["spans"], F.array(F.struct((a["at"] + p["lead"]).alias("start"), p["loss"].alias("length"))))).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    used = F.aggregate("pieces", F.lit(0).cast("long"), lambda s, p: s + p["tokens"])
    return whole.select(
        "conv_id", "window", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), spans.alias("loss_spans"), used.alias("n_tokens"),
        F.size(F.filter("pieces", lambda p: ~p["new"])).alias("n_repeated"), (used > budget).alias("over_budget"),
    )


def _piece(role: Column, text: Column) -> list[Column]:
    lead = F.concat(F.when(role == ASSISTANT, "<s>").otherwise("[INST]"), _escaped_role(role), F.lit("\n"))
    close = F.when(role == ASSISTANT, "</s>").otherwise("[/INST]")
    return [F.concat(lead, escaped(text), close).alias("piece"), F.char_length(lead).alias("lead")]


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted in windows, with digests read back from the formatted texts."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    own = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")) for k, r in enumerate(("user", "assistant"))])).alias("x")).select("x.*")
    return digests(chat_windows(turns.unionByName(own)))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation what its windows hold: turns that are new in them, and texts under the loss mask."""
    turns = F.slice(parsed(F.col("formatted")), F.col("n_repeated") + 1, F.greatest(F.lit(1), F.char_length("formatted")))
    read = windows.select(
        "conv_id", "window", F.char_length("formatted").cast("long").alias("chars"), turns.alias("turns"),
        F.array_join(F.transform("loss_spans", lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))), "").alias("loss"),
    )
    part = F.struct("window", F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"), "loss")
    whole = read.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.sum(F.size("turns")).cast("long").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"))
    text = lambda c: F.array_join(F.transform("parts", lambda p: p[c]), "")
    return whole.withColumn("__loss", text("loss")).select(
        "conv_id", "n_turns", F.sha2(text("turns"), 256).alias("turns_sha256"), F.char_length("__loss").cast("long").alias("loss_chars"), F.sha2("__loss", 256).alias("loss_sha256"), "formatted_chars", "n_windows"
    )


#: The windows again, by a recursion over conversations; a greater turn number never ties here.
OP1_SQL = r"""
WITH RECURSIVE input AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, k, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) own(k, r)
), escaped AS (
  SELECT dense_rank() OVER (ORDER BY conv_id) AS c,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos, *,
    regexp_replace(regexp_replace(replace(text, '\', '\\'), '([<\[])(/?(?:INST\]|s>|SYS>>))', '\1\\\2', 'g'), '([<\[])(<\\/?SYS>>)', '\1\\\2', 'g') AS body,
    replace(regexp_replace(regexp_replace(replace(role, '\', '\\'), '([<\[])(/?(?:INST\]|s>|SYS>>))', '\1\\\2', 'g'), '([<\[])(<\\/?SYS>>)', '\1\\\2', 'g'), chr(10), '\' || chr(10)) AS erole
  FROM input
), pieces AS (
  SELECT c, conv_id, pos, role, text,
    CASE WHEN role = 'assistant' THEN '<s>' || erole || chr(10) || body || '</s>' ELSE '[INST]' || erole || chr(10) || body || '[/INST]' END AS piece
  FROM escaped
), counted AS (
  SELECT c, pos, pos = 0 AND role = 'system' AS opens, length(piece) AS chars,
    greatest(1, len(regexp_extract_all(piece, '[A-Za-z]{1,3}|[0-9]{1,3}|[^\x20\x09-\x0DA-Za-z0-9]')) + (strlen(piece) - length(piece)) // 2) AS tokens
  FROM pieces
), laid AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY c ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    max(CASE WHEN opens THEN tokens ELSE 0 END) OVER (PARTITION BY c) AS system_tokens,
    max(CASE WHEN opens THEN chars ELSE 0 END) OVER (PARTITION BY c) AS system_chars
  FROM counted
), past AS (
  SELECT i.c, i.pos, count(h.pos) AS h, coalesce(sum(h.tokens), 0) AS held, coalesce(sum(h.chars), 0) AS held_chars
  FROM laid i LEFT JOIN laid h ON h.c = i.c AND h.pos < i.pos AND NOT h.opens
    AND i.before - h.before <= least(128, greatest(0, 1024 - i.system_tokens - i.tokens))
  GROUP BY ALL
), ends AS (
  SELECT i.c, i.pos, min(j.pos) AS next
  FROM laid i JOIN past p ON p.c = i.c AND p.pos = i.pos JOIN laid j ON j.c = i.c AND j.pos > i.pos
    AND (j.before + j.tokens > i.before + 1024 - CASE WHEN i.pos > 0 THEN i.system_tokens + p.held ELSE 0 END OR j.before // 65536 > i.before // 65536)
  GROUP BY ALL
), starts AS (
  SELECT c, 0::BIGINT AS pos FROM laid WHERE pos = 0
  UNION ALL
  SELECT s.c, e.next FROM starts s JOIN ends e ON e.c = s.c AND e.pos = s.pos
), windows AS (
  SELECT s.c, count(*)::BIGINT AS n_windows, sum(CASE WHEN s.pos > 0 THEN l.system_chars + p.held_chars ELSE 0 END) AS repeated_chars
  FROM starts s JOIN laid l ON l.c = s.c AND l.pos = s.pos JOIN past p ON p.c = s.c AND p.pos = s.pos
  GROUP BY ALL
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(length(piece)) + max(w.repeated_chars))::BIGINT AS formatted_chars, max(w.n_windows)::BIGINT AS n_windows
FROM pieces JOIN windows w USING (c)
GROUP BY conv_id
"""
