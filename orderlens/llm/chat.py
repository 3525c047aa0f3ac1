"""Chat formatting with DataFrame and SQL functions only.

Conversations arrive in many layouts: one row a turn, a list of messages, a prompt and a
response, an instruction with input and output. A layout is recognised by its schema
fingerprint, the hash of its sorted nested field paths, which selects a declarative
mapping to canonical turns (conv_id, turn, role, text): `canonical_turns` for a typed
table, `canonical_json` row by row for JSON rows of mixed layouts (the paths of each row
come from its variant schema, so one table may mix layouts).

`format_turns` writes one text a conversation:

    <turn>### role
    text</turn>

each turn ending with a line feed. Inside roles and texts the escape character and the
characters that begin control strings are replaced (`ESCAPES`), so no control string can
occur in them, and `read_turns` gives back exactly what went in. The loss mask is a list of
spans (start, length in code points of the formatted text) that cover the assistant texts.

Results for edge cases: null text or role: empty; turns are ordered by (turn, role, text),
nulls first, and repeated rows stay; null conversation ids are one conversation; an unknown
layout raises ValueError in `canonical_turns`, and in `canonical_json` gives a row with a
null layout and no turns; an empty table gives none; extra columns are left out of the
fingerprint when they aren't part of the mapping: a table with the columns of one row a turn
is read so, whatever other columns it has, and fields that fit two mappings, neither of which
holds the other, raise ValueError.

A conversation is one output row, so its turns meet in one task: that is the size of the
result, not of the table.
"""
from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

TURN, END, LOSS_ROLE = "<turn>### ", "</turn>\n", "assistant"
#: In this order when writing; backwards when reading.
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), ("\n", "\\n"))
_TEXT_ESCAPES = ESCAPES[:3]  # a text may hold line feeds, a role may not


class Layout(NamedTuple):
    """A mapping: the field paths that it needs, and turns as (role, text path) pairs, or
    a list path with the names of its role and text fields, or one row a turn."""

    name: str
    id: str
    turns: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    row: tuple[str, str, str] | None = None

    @property
    def paths(self) -> list[str]:
        if self.row:
            return sorted((self.id, *self.row))
        if self.each:
            return sorted((self.id, *(f"{self.each[0]}[].{f}" for f in self.each[1:])))
        return sorted((self.id, *(p for _, p in self.turns)))

    @property
    def fingerprint(self) -> str:
        return hash_paths(self.paths)


def hash_paths(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


LAYOUTS = (
    Layout("flat", "conv_id", row=("turn", "role", "text")),
    Layout("messages", "conv_id", each=("messages", "role", "content")),
    Layout("sharegpt", "conv_id", each=("conversations", "from", "value")),
    Layout("prompt_response", "conv_id", turns=(("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_completion", "conv_id", turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout("instruction", "conv_id", turns=(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("instruction_output", "conv_id", turns=(("user", "instruction"), ("assistant", "output"))),
    Layout("system_prompt_response", "conv_id", turns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("nested_prompt", "conv_id", turns=(("user", "prompt.text"), ("assistant", "response.text"))),
)
#: Names of roles in lists of messages; a table of one row a turn keeps its own.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Paths of the leaves of a type: `a.b` in structs, `a[]` in arrays."""
    if isinstance(kind, T.StructType):
        return [p for f in kind for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def _layout_of(schema: T.StructType, layouts: tuple[Layout, ...]) -> Layout:
    by_hash = {x.fingerprint: x for x in layouts}
    paths = field_paths(schema)
    if found := by_hash.get(hash_paths(paths)):
        return found
    # Extra columns: one row a turn if its columns are there, else the mapping whose own paths
    # are all there and hold those of any other that fits.
    inside = [x for x in layouts if {*x.paths} <= {*paths}]
    if not inside:
        raise ValueError(f"no layout for the fields {sorted(paths)}")
    inside = [x for x in inside if x.row] or inside
    widest = max(inside, key=lambda x: len(x.paths))
    if other := [x.name for x in inside if not {*x.paths} <= {*widest.paths}]:
        raise ValueError(f"the fields {sorted(paths)} fit several layouts: {[widest.name, *other]}")
    return widest


def _role(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(F.element_at(known, role), role, F.lit(""))


def canonical_turns(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text) by the mapping that the schema's fingerprint selects."""
    layout = _layout_of(df.schema, layouts)
    if layout.row:
        turn, role, text = (F.col(c) for c in layout.row)
        return df.select(F.col(layout.id).alias("conv_id"), turn.cast("long").alias("turn"), F.coalesce(role.cast("string"), F.lit("")).alias("role"),
                         F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    if layout.each:
        path, role, text = layout.each
        turns = F.transform(F.col(path), lambda m: F.struct(m[role].alias("role"), m[text].alias("text")))
    else:
        turns = F.array(*[F.struct(F.lit(role).alias("role"), F.col(path).cast("string").alias("text")) for role, path in layout.turns])
    return (df.select(F.col(layout.id).alias("conv_id"), F.posexplode(turns).alias("turn", "t"))
            .select("conv_id", F.col("turn").cast("long"), _role(F.col("t.role")).alias("role"), F.coalesce("t.text", F.lit("")).alias("text")))


def _variant_signature(layout: Layout) -> str:
    """The field paths as `schema_of_variant` shows them, types left out."""
    def shown(fields: dict) -> str:
        return "OBJECT<" + ", ".join(f"{k}: {shown(v) if isinstance(v, dict) else v}" for k, v in sorted(fields.items())) + ">"

    if layout.each:
        return shown({layout.id: "_", layout.each[0]: "ARRAY<" + shown({f: "_" for f in layout.each[1:]}) + ">"})
    fields: dict = {}
    for path in layout.paths:
        at = fields
        *above, leaf = path.split(".")
        for part in above:
            at = at.setdefault(part, {})
        at[leaf] = "_"
    return shown(fields)


def canonical_json(df: DataFrame, json_col: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, layout, turns array<struct<role, text>>) of JSON rows in mixed layouts:
    each row's mapping is selected by the hash of its own nested field paths."""
    rows = df.select(F.try_parse_json(F.col(json_col)).alias("v"))
    shape = F.regexp_replace(F.schema_of_variant("v"), r"\b(BIGINT|STRING|DOUBLE|BOOLEAN|VOID|DATE|DECIMAL\(\d+,\d+\))(?=[,>]|$)", "_")
    rows = rows.withColumn("print", F.sha2(shape, 256))
    name, turns, conv = F.lit(None).cast("string"), F.array().cast("array<struct<role:string,text:string>>"), F.lit(None).cast("string")
    for x in layouts:
        mine = F.col("print") == F.sha2(F.lit(_variant_signature(x)), 256)
        if x.each:
            path, role, text = x.each
            got = F.transform(F.variant_get("v", f"$.{path}", f"array<struct<{_quoted(role)}:string,{_quoted(text)}:string>>"), _message(role, text))
        else:
            pairs = x.turns or ((None, x.row[2]),)
            got = F.array(*[F.struct((F.lit(role) if role else F.coalesce(F.variant_get("v", f"$.{x.row[1]}", "string"), F.lit(""))).alias("role"),
                                     F.coalesce(F.variant_get("v", f"$.{path}", "string"), F.lit("")).alias("text")) for role, path in pairs])
        name = F.when(mine, F.lit(x.name)).otherwise(name)
        turns = F.when(mine, got).otherwise(turns)
        conv = F.when(mine, F.variant_get("v", f"$.{x.id}", "string")).otherwise(conv)
    return rows.select(conv.alias("conv_id"), name.alias("layout"), turns.alias("turns"))


def _message(role: str, text: str):
    return lambda m: F.struct(_role(m[role]).alias("role"), F.coalesce(m[text], F.lit("")).alias("text"))


def _quoted(name: str) -> str:
    return name if re.fullmatch(r"[a-z_]+", name) and name != "from" else f"`{name}`"


def escape(text: Column, pairs=_TEXT_ESCAPES) -> Column:
    for raw, coded in pairs:
        text = F.replace(text, F.lit(raw), F.lit(coded))
    return text


def unescape(text: Column, pairs=_TEXT_ESCAPES) -> Column:
    for raw, coded in reversed(pairs):
        text = F.replace(text, F.lit(coded), F.lit(raw))
    return text


def format_turns(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, formatted string, loss array<struct<start, length>>) of canonical turns."""
    role, text = escape(F.coalesce("role", F.lit("")), ESCAPES), escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(TURN), role, F.lit("\n"))
    pieces = turns.select("conv_id", "turn", "role", "text", head.alias("head"), text.alias("body"))
    inside = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    size = F.char_length("head") + F.char_length("body") + F.lit(len(END))
    upto = F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = pieces.select(
        "conv_id", F.row_number().over(inside).alias("at"), F.concat("head", "body", F.lit(END)).alias("piece"),
        F.when(F.col("role") == loss_role, F.struct((upto - len(END) - F.char_length("body")).alias("start"), F.char_length("body").alias("length"))).alias("span"))
    return (placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "piece", "span"))).alias("p"))
            .select("conv_id", F.array_join("p.piece", "").alias("formatted"),
                    F.filter("p.span", lambda s: s.isNotNull()).alias("loss")))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns of a formatted text."""
    pieces = F.filter(F.split(formatted, re.escape(END)), lambda p: p != "")
    bodies = F.transform(pieces, lambda p: F.substr(p, F.lit(len(TURN) + 1)))
    return F.transform(bodies, lambda b: F.struct(
        unescape(F.substring_index(b, "\n", 1), ESCAPES).alias("role"),
        unescape(F.substr(b, F.char_length(F.substring_index(b, "\n", 1)) + 2)).alias("text")))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
