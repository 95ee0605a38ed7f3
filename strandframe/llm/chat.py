"""Chat formatting with DataFrame functions alone: layouts are told apart by a fingerprint of their fields.

A record is one JSON object. ``schema_of_variant`` gives its nested fields; their names and
nesting, without the types, are hashed, and the hash selects a declarative mapping: where the
turns are, which field names the role and which the text. What a record maps to is a row per
turn, so a long conversation in the layout of one row per turn is never one record.

The format marks turns as ``<turn>role``, a line end, the text and ``</turn>`` with a line end. In
roles and texts ``\\`` becomes ``\\\\`` and ``<`` becomes ``\\l`` (in roles a line end becomes ``\\n``
too), so no mark can occur in them and the way back is exact.

A null role or text is empty. Rows are ordered by turn (null first), then role and text; repeated
rows are turns of their own. A record whose fingerprint has no mapping gives no turn: it is
listed by ``unmapped``. An empty table gives an empty result. One conversation is one row of
output, so its size is bounded by the longest conversation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """``example`` has the fields whose fingerprint selects this layout.

    ``turns``: path of an array of turns with the fields ``role`` and ``text``; or None, and then
    ``fixed`` lists (role, path) in order; or, for a row per turn, (path of role, path of text).
    """

    name: str
    example: str
    turns: str | None = None
    role: str = "$.role"
    text: str = "$.text"
    fixed: tuple[tuple[str, str], ...] = ()


LAYOUTS = (
    Layout("turn", '{"role": "r", "text": "t"}', None),
    Layout("turn_without_role", '{"text": "t"}', None),
    Layout("turn_without_text", '{"role": "r"}', None),
    Layout("turn_empty", "{}", None),
    Layout("messages", '{"messages": [{"role": "r", "content": "t"}]}', "$.messages", "$.role", "$.content"),
    Layout("conversations", '{"conversations": [{"from": "r", "value": "t"}]}', "$.conversations", "$.from", "$.value"),
    Layout("prompt", '{"prompt": "p", "completion": "c"}', fixed=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout("instruction", '{"instruction": "i", "output": "o"}', fixed=(("user", "$.instruction"), ("assistant", "$.output"))),
    Layout("instruction_input", '{"instruction": "i", "input": "x", "output": "o"}', fixed=(("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Layout("system_prompt", '{"system": "s", "prompt": "p", "response": "r"}', fixed=(("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.response"))),
    Layout("nested", '{"input": {"messages": [{"role": "r", "content": "t"}]}}', "$.input.messages", "$.role", "$.content"),
)
#: Names of roles in the layouts -> canonical roles; any other name stays as it is.
ROLES = {"human": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant"}
OPEN, CLOSE = "<turn>", "</turn>\n"


def field_paths(variant: Column) -> Column:
    """Names and nesting of a record's fields: its schema without the types of the leaves."""
    return F.regexp_replace(F.schema_of_variant(variant), r": (?!ARRAY<|OBJECT<)[A-Z]+(\([0-9, ]+\))?", "")


def fingerprint(variant: Column) -> Column:
    return F.xxhash64(field_paths(variant))


def _turn(layout: Layout, x: Column) -> Column:
    return F.struct(
        F.coalesce(F.try_variant_get(x, layout.role, "string"), F.lit("")).alias("role"),
        F.coalesce(F.try_variant_get(x, layout.text, "string"), F.lit("")).alias("text"),
    )


def canonical_turns(records: DataFrame) -> DataFrame:
    """(conv_id, turn, place, role, text) from (conv_id, turn, record as JSON text), by the layout of each record."""
    parsed = records.select("conv_id", "turn", F.try_parse_json("record").alias("v")).withColumn("print", fingerprint(F.col("v")))
    paths = dict(zip((x.name for x in LAYOUTS), _prints(records)))
    array = "array<struct<role:string,text:string>>"
    turns = F.lit(None).cast(array)

    def text(path: str) -> Column:
        return F.coalesce(F.try_variant_get("v", path, "string"), F.lit(""))

    for layout in LAYOUTS:
        if layout.turns:
            inner = F.coalesce(F.try_variant_get("v", layout.turns, "array<variant>"), F.array().cast("array<variant>"))
            made = F.transform(inner, lambda x: _turn(layout, x))  # noqa: B023  used at once
        elif layout.fixed:
            made = F.array(*[F.struct(F.lit(r).alias("role"), text(p).alias("text")) for r, p in layout.fixed])
        else:
            made = F.array(F.struct(text(layout.role).alias("role"), text(layout.text).alias("text")))
        turns = F.when(F.col("print") == F.lit(paths[layout.name]), made).otherwise(turns)
    out = parsed.select("conv_id", "turn", F.posexplode(turns).alias("place", "_t"))
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return out.select("conv_id", "turn", "place", F.coalesce(names[F.col("_t.role")], F.col("_t.role")).alias("role"), F.col("_t.text").alias("text"))


def unmapped(records: DataFrame) -> DataFrame:
    """Records without a mapping, with their fingerprint and fields."""
    parsed = records.withColumn("v", F.try_parse_json("record"))
    known = list(_prints(records))
    mine = parsed.withColumn("print", fingerprint(F.col("v"))).withColumn("fields", field_paths(F.col("v")))
    return mine.filter(F.col("v").isNull() | ~F.col("print").isin(known)).drop("v")


def _prints(records: DataFrame) -> list[int]:
    """Fingerprints of the layouts' examples (a row of constants)."""
    one = records.sparkSession.range(1).select(*[fingerprint(F.parse_json(F.lit(x.example))).alias(x.name) for x in LAYOUTS])
    return list(one.first())


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if role else out


def unescape(text: Column, role: bool = False) -> Column:
    """Between doubled back slashes no single one is part of a pair."""
    def plain(x: Column) -> Column:
        x = F.replace(x, F.lit("\\l"), F.lit("<"))
        return F.replace(x, F.lit("\\n"), F.lit("\n")) if role else x

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` and ``loss_mask``, the (start, length) in code points of each assistant text."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "place", "role", "text")
    body = escape(F.col("text"))
    head = F.concat(F.lit(OPEN), escape(F.col("role"), True), F.lit("\n"))
    cut = turns.withColumn("_n", F.row_number().over(order)).withColumn("_head", head).withColumn("_body", body)
    cut = cut.withColumn("_size", (F.length("_head") + F.length("_body") + len(CLOSE)).cast("long"))
    before = F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = cut.withColumn("_at", before + F.length("_head"))
    packed = F.array_sort(F.collect_list(F.struct(
        "_n", F.concat("_head", "_body", F.lit(CLOSE)).alias("piece"), (F.col("role") == "assistant").alias("loss"),
        F.struct(F.col("_at").cast("int").alias("start"), F.length("_body").alias("length")).alias("span"))))
    out = cut.groupBy("conv_id").agg(packed.alias("_p"))
    return out.select(
        "conv_id", F.array_join(F.transform("_p", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter("_p", lambda x: x["loss"]), lambda x: x["span"]).alias("loss_mask"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    pieces = F.split(formatted, CLOSE)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(x: Column) -> Column:
        end = F.position(F.lit("\n"), x)
        return F.struct(
            unescape(F.substring(x, F.lit(len(OPEN) + 1), end - len(OPEN) - 1), True).alias("role"),
            unescape(F.substring(x, end + 1, F.length(x))).alias("text"),
        )

    return F.transform(pieces, turn)


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, one after the other."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
