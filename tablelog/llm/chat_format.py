"""Chat formatting: typed content parts flattened to one string per conversation, in DataFrame functions only.

A message is a role and a list of parts (type, text, ref, tokens). The visitor walks the parts in order: text is escaped and
kept, image, audio and document parts become numbered placeholders; the references and the tokens that each expands to are
recorded. The template is

    <|turn|>role\\n content<|end|>\\n

(without the blank). Inside roles and texts a backslash is doubled, and one is put after the first character of every
control string, so none of them occurs in formatted text unless the template wrote it; unescape() undoes both.

A conversation's messages are gathered once, by its id, after a map-side combine; the walk over its parts and turns are windows
and aggregations on the same partitioning, so they need no other exchange, and their cost grows as the conversation does (and its
sort), not as its square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Control strings of common chat templates that never pass through unescaped.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|")
OPEN, BREAK, CLOSE = "<|turn|>", "\n", "<|end|>\n"
#: Types of parts that become placeholders such as <|image:0|>.
PLACES = ("image", "audio", "document")
#: Code points of the pieces that formatted text is read back from.
CHUNK = 4096
_ESCAPED = r"\\|<(?=/?s>|</?SYS>>|\|)|\[(?=/?INST\])"
_BLOCK = r"(?s)<\|turn\|>(.*?)\n(.*?)<\|end\|>\n"
PART = "struct<type:string,text:string,ref:string,tokens:int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _ESCAPED, r"$0\\")


def unescape(text: Column) -> Column:
    """Each backslash that a doubled or broken string holds goes; a doubled one leaves one."""
    return F.regexp_replace(text, r"(?s)(\\)\\|\\", "$1")


def escape_role(role: Column) -> Column:
    """As escape, and a line break becomes backslash n."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    broken = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return unescape(broken)


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens")))


def format_chats(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts", learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: its id, n_turns, formatted, turns, loss_spans, attachments, expanded_tokens.

    parts_col: array of struct(type, text, ref, tokens) or a string, which counts as one text part. Types other than image,
    audio and document count as text. turns: array of (role, content); loss_spans: array of (start, end) code points of
    formatted, end exclusive, one per turn whose role is in learn; attachments: array of (turn_no, type, ref, tokens) in
    order, numbered by their place as the placeholders are; expanded_tokens: sum of their tokens.

    Turns go by turn, then role, then content, nulls first, so ties and repeated rows have one order; repeated rows are
    turns of their own. Null roles, texts and part lists count as empty; a null conversation id is a conversation of its own.
    Empty table: empty result. Other columns, whatever their names, are not read.
    """
    is_text = messages.schema[parts_col].dataType.typeName() == "string"
    parts = text_parts(F.col(parts_col)) if is_text else F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>"))
    row = F.struct(F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), parts.cast(f"array<{PART}>").alias("parts"))
    grouped = messages.select(F.col(conv_col).alias("_c"), row.alias("_m")).groupBy("_c").agg(F.sort_array(F.collect_list("_m")).alias("_m"))
    turns = _visited(grouped.select("_c", F.posexplode("_m").alias("_i", "_m")).select("_c", "_i", "_m.role", "_m.parts"))
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(BREAK))
    turns = turns.withColumns({"_head": F.length(head), "_block": F.concat(head, "content", F.lit(CLOSE))})
    before = F.coalesce(F.sum(F.length("_block")).over(Window.partitionBy("_c").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turns = turns.withColumn("_at", (before + F.col("_head")).cast("long"))
    span = F.when(F.col("role").isin(*learn), F.struct(F.col("_at").alias("start"), (F.col("_at") + F.length("content")).alias("end")))
    whole = turns.groupBy("_c").agg(F.sort_array(F.collect_list(F.struct("_i", "role", "content", "_block", span.alias("span"), "attached"))).alias("_t"))
    attachments = F.flatten(F.transform("_t", lambda t: t.attached))
    return whole.select(
        F.col("_c").alias(conv_col),
        F.size("_t").cast("long").alias("n_turns"),
        F.array_join(F.transform("_t", lambda t: t["_block"]), "").alias("formatted"),
        F.transform("_t", lambda t: F.struct(t.role.alias("role"), t.content.alias("content"))).alias("turns"),
        F.transform(F.filter("_t", lambda t: t.span.isNotNull()), lambda t: t.span).alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a.tokens).alias("expanded_tokens"),
    )


def _visited(turns: DataFrame) -> DataFrame:
    """The visitor: (_c, _i, role, parts) -> (_c, _i, role, content, attached). It walks all parts of a conversation in order,
    one row each: a text is escaped, any other part becomes a placeholder with its place among those so far."""
    part = turns.select("_c", "_i", "role", F.posexplode_outer("parts").alias("_k", "_p"))
    part = part.withColumn("_other", F.coalesce(F.col("_p.type"), F.lit("")).isin(*PLACES))
    so_far = Window.partitionBy("_c").orderBy("_i", "_k").rowsBetween(Window.unboundedPreceding, -1)
    number = F.coalesce(F.sum(F.col("_other").cast("int")).over(so_far), F.lit(0))
    place = F.concat(F.lit("<|"), F.col("_p.type"), F.lit(":"), number.cast("string"), F.lit("|>"))
    part = part.withColumn("_piece", F.when(F.col("_other"), place).otherwise(escape(F.col("_p.text"))))
    kept = F.struct(F.col("_i").alias("turn_no"), F.col("_p.type").alias("type"), F.col("_p.ref").alias("ref"), F.coalesce("_p.tokens", F.lit(0)).alias("tokens"))
    visited = part.groupBy("_c", "_i", "role").agg(
        F.sort_array(F.collect_list(F.struct("_k", "_piece"))).alias("_pieces"), F.sort_array(F.collect_list(F.when(F.col("_other"), F.struct("_k", kept.alias("a"))))).alias("_a")
    )
    return visited.select("_c", "_i", "role", F.array_join(F.transform("_pieces", lambda x: x["_piece"]), "").alias("content"), F.transform("_a", lambda x: x.a).alias("attached"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text), unescaped; placeholders stay as the template wrote them."""
    heads = F.regexp_extract_all(formatted, F.lit(_BLOCK), F.lit(1))
    bodies = F.regexp_extract_all(formatted, F.lit(_BLOCK), F.lit(2))
    return F.zip_with(heads, bodies, lambda r, t: F.struct(unescape_role(r).alias("role"), unescape(t).alias("text")))


def chunks(text: Column) -> Column:
    """A text in pieces of CHUNK code points, so a span of it is found without a walk from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def _let(value: Column, then) -> Column:
    """then(value), with the value worked out once however often then() names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def masked(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""

    def cut(pieces: Column, s: Column) -> Column:
        first = F.floor(s.start / CHUNK).cast("int")
        held = F.array_join(F.slice(pieces, first + 1, F.floor(s.end / CHUNK).cast("int") - first + 1), "")
        return unescape(F.substring(held, (s.start - first * CHUNK + 1).cast("int"), (s.end - s.start).cast("int")))

    return _let(chunks(formatted), lambda pieces: F.array_join(F.transform(spans, lambda s: cut(pieces, s)), ""))


def digest(chats: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The query's columns, read back from formatted."""
    got = chats.select(conv_col, "formatted", read_back(F.col("formatted")).alias("_t"), masked(F.col("formatted"), F.col("loss_spans")).alias("_loss"))
    said = F.array_join(F.transform("_t", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return got.select(
        conv_col,
        F.size("_t").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
