"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

A layout's fingerprint is the hash of its nested field paths (with their container
kinds). Mappings are data: for a fingerprint they name where roles and texts are.
Canonical turns are ``array<struct<role, text>>``; a template writes them as one
string in which control strings inside roles and texts are escaped reversibly.

Defined cases: a null text or role is empty; rows of one conversation are ordered by
turn, then role, then text, so repeated rows stay as turns of their own; a null
conversation id is one conversation; a conversation without turns has an empty
string; unknown layouts raise ``ValueError`` naming the fingerprint; unmapped and
extra columns never change a fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns: its field paths and the kind of layout.

    kind "rows": one row a turn (key, order, role, text columns); kind "list": an array
    of structs (list, role, text); kind "columns": one column a role, in order.
    """

    name: str
    kind: str
    fields: tuple[str, ...]
    roles: tuple[str, ...] = ()

    @property
    def paths(self) -> tuple[str, ...]:
        if self.kind == "list":
            return (f"{self.fields[0]}[]", *(f"{self.fields[0]}[].{x}" for x in self.fields[1:]))
        return self.fields


MAPPINGS = (
    Mapping("turn rows", "rows", ("conv_id", "turn", "role", "text")),
    Mapping("messages", "list", ("messages", "role", "content")),
    Mapping("from and value", "list", ("conversations", "from", "value")),
    Mapping("instruction with input", "columns", ("instruction", "input", "output"), ("user", "user", "assistant")),
    Mapping("instruction", "columns", ("instruction", "output"), ("user", "assistant")),
    Mapping("prompt and completion", "columns", ("prompt", "completion"), ("user", "assistant")),
    Mapping("question and answer", "columns", ("question", "answer"), ("user", "assistant")),
)


def field_paths(schema: T.DataType, at: str = "") -> set[str]:
    """Every nested field path of a schema; ``[]`` marks an array, ``{}`` a map."""
    if isinstance(schema, T.StructType):
        out = {at} if at else set()
        for f in schema.fields:
            out |= field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)
        return out
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, at + "[]")
    if isinstance(schema, T.MapType):
        return field_paths(schema.valueType, at + "{}")
    return {at}


def fingerprint(paths: Sequence[str]) -> str:
    """The hash of sorted field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def table_of(mappings: Sequence[Mapping]) -> dict[str, Mapping]:
    """Mappings by the fingerprint of their paths."""
    return {fingerprint(m.paths): m for m in mappings}


def select_mapping(schema: T.StructType, mappings: Sequence[Mapping] = MAPPINGS) -> Mapping:
    """The mapping that the fingerprint of the schema's known paths names.

    Paths that no mapping has are left out before hashing. Where several layouts lie in one
    schema, the fingerprint is none of theirs, and the largest of them counts.
    """
    there, known = field_paths(schema), table_of(mappings)
    own = there & {p for m in mappings for p in m.paths}
    if (found := known.get(fingerprint(sorted(own)))) is not None:
        return found
    inside = [m for m in mappings if set(m.paths) <= own]
    if inside:
        return max(inside, key=lambda m: len(m.paths))
    raise ValueError(f"no mapping for the layout {fingerprint(sorted(there))}: {sorted(there)}")


def _turn(role: Column, text: Column) -> Column:
    named = role
    for a, b in ROLES.items():
        named = F.when(role == a, F.lit(b)).otherwise(named)
    return F.struct(F.coalesce(named, F.lit("")).cast("string").alias("role"), F.coalesce(text, F.lit("")).cast("string").alias("text"))


def canonical_turns(df: DataFrame, *, mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """``df`` in its layout as rows with ``turns``; "rows" layouts give (key, turns), others keep other columns."""
    m = select_mapping(df.schema, mappings)
    if m.kind == "rows":
        key, order, role, text = m.fields
        # Only the key, order and turn of a conversation are gathered: one conversation is one record.
        turns = df.select(F.col(key), F.col(order).alias("__order"), _turn(F.col(role), F.col(text)).alias("__turn"))
        return turns.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("__order", "__turn"))), lambda x: x["__turn"]).alias("turns"))
    rest = [c for c in df.columns if c not in (*m.fields, "turns")]
    if m.kind == "list":
        source, role, text = m.fields
        out = F.coalesce(F.transform(F.col(source), lambda x: _turn(x[role], x[text])), F.array().cast(TURNS))
    else:
        each = F.array(*(_turn(F.lit(r), F.col(c)) for r, c in zip(m.roles, m.fields, strict=True)))
        optional = [c for c in m.fields if c == "input"]
        empty = F.array(*(F.lit(False) if c not in optional else F.coalesce(F.col(c), F.lit("")) == "" for c in m.fields))
        out = F.transform(F.filter(F.arrays_zip(each.alias("t"), empty.alias("e")), lambda x: ~x["e"]), lambda x: x["t"])
    return df.select(*rest, out.alias("turns"))


def turns_of_json(df: DataFrame, json_col: str, *, mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """``df`` plus fingerprint, layout and turns of each row's JSON object, whose layout may differ from row to row.

    A row's fingerprint is the hash of its nested field paths, as far as any mapping knows
    them; it is looked up in the table of mappings' fingerprints. Rows of no known layout,
    and null or broken JSON, have a null layout and null turns. Only layouts of one row a
    conversation apply; columns of these names are replaced.
    """
    single = [m for m in mappings if m.kind != "rows"]
    raw = F.col(json_col)
    top = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    paths = [F.filter(top, lambda x: x.isin(sorted({p for m in single for p in m.paths if "[]" not in p})))]
    for name in sorted({m.fields[0] for m in single if m.kind == "list"}):
        parts = sorted({p.partition("[].")[2] for m in single if m.kind == "list" and m.fields[0] == name for p in m.paths} - {""})
        items = F.from_json(F.get_json_object(raw, f"$.{name}"), "array<string>")
        # The fields of a list's items are those that any of them has; an empty list has its layout's.
        fields = F.array_distinct(F.flatten(F.transform(items, lambda x: F.coalesce(F.json_object_keys(x), F.array().cast("array<string>")))))
        known = F.filter(fields, lambda x: x.isin(parts))  # noqa: B023
        inside = F.when(F.size(items) == 0, F.array(*map(F.lit, parts))).otherwise(known)
        paths.append(F.when(items.isNotNull(), F.concat(F.array(F.lit(f"{name}[]")), F.transform(inside, lambda x: F.concat(F.lit(f"{name}[]."), x)))).otherwise(F.array().cast("array<string>")))  # noqa: B023
    print_ = F.left(F.sha2(F.array_join(F.array_sort(F.concat(*paths)), "\n"), 256), F.lit(16))
    names = F.create_map(*[F.lit(x) for key, m in table_of(single).items() for x in (key, m.name)])
    base = df.select(*[c for c in df.columns if c not in ("fingerprint", "layout", "turns")], F.when(raw.isNotNull(), print_).alias("fingerprint"))
    base = base.withColumn("layout", F.try_element_at(names, F.col("fingerprint")))
    turns = F.lit(None).cast(TURNS)
    for m in single:
        if m.kind == "list":
            source, role, text = m.fields
            items = F.from_json(F.get_json_object(raw, f"$.{source}"), f"array<struct<`{role}`:string,`{text}`:string>>")
            made = F.transform(F.filter(items, lambda x: x.isNotNull()), lambda x: _turn(x[role], x[text]))  # noqa: B023
        else:
            each = [(r, F.get_json_object(raw, f"$.{c}"), c) for r, c in zip(m.roles, m.fields, strict=True)]
            made = F.filter(F.array(*[F.when((F.lit(c) != "input") | (F.coalesce(t, F.lit("")) != ""), _turn(F.lit(r), t)) for r, t, c in each]), lambda x: x.isNotNull())
        turns = F.when(F.col("layout") == m.name, made).otherwise(turns)
    return base.withColumn("turns", turns)


@dataclass(frozen=True)
class Template:
    """Control strings of a chat format. All begin with ``opening``, which escaping keeps out of texts."""

    opening: str = "<|"
    turn: str = "<|turn|>"
    body: str = "<|body|>"
    end: str = "<|end|>"

    def escaped(self, c: Column) -> Column:
        """One more backslash inside each ``<|``, ``<\\|``, ...: no control string can appear, and none is lost."""
        a, b = self.opening
        return F.regexp_replace(c, rf"\{a}(\\*)\{b}", rf"{a}\\$1{b}")

    def unescaped(self, c: Column) -> Column:
        a, b = self.opening
        return F.regexp_replace(c, rf"\{a}\\(\\*)\{b}", rf"{a}$1{b}")


def format_turns(df: DataFrame, *, template: Template = Template(), turns_col: str = "turns") -> DataFrame:
    """``df`` plus ``formatted`` and ``loss_mask``: (start, length) of assistant texts, counted in code points from 0."""
    t = template
    head = F.transform(turns_col, lambda x: F.concat(F.lit(t.turn), t.escaped(x["role"]), F.lit(t.body)))
    body = F.transform(turns_col, lambda x: t.escaped(x["text"]))
    kept = [c for c in df.columns if c not in ("formatted", "loss_mask")]
    parts = df.select(*kept, F.transform(F.arrays_zip(head.alias("h"), body.alias("b"), F.col(turns_col).alias("t")), lambda x: F.struct(x["h"].alias("h"), x["b"].alias("b"), (x["t"]["role"] == "assistant").alias("learn"))).alias("__parts"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["h"])
        span = F.array(F.struct(start.alias("start"), F.char_length(x["b"]).alias("length")))
        return F.struct((start + F.char_length(x["b"]) + F.lit(len(t.end))).alias("at"), F.when(x["learn"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return parts.select(
        *kept,
        F.array_join(F.transform("__parts", lambda x: F.concat(x["h"], x["b"], F.lit(t.end))), "").alias("formatted"),
        F.aggregate("__parts", zero, step, lambda acc: acc["spans"]).alias("loss_mask"),
    )


def parse_turns(formatted: Column, template: Template = Template()) -> Column:
    """Turns read back from a formatted string."""
    t = template
    pieces = F.split(formatted, _quote(t.end))
    whole = F.filter(pieces, lambda x: x.startswith(t.turn))

    def turn(x: Column) -> Column:
        pair = F.split(F.substr(x, F.lit(len(t.turn) + 1)), _quote(t.body))
        return F.struct(t.unescaped(F.get(pair, F.lit(0))).alias("role"), t.unescaped(F.get(pair, F.lit(1))).alias("text"))

    return F.transform(whole, turn)


def _quote(text: str) -> str:
    return "".join("\\" + c if c in "<|>[](){}*+?.^$\\" else c for c in text)


def masked_texts(formatted: Column, loss_mask: Column, template: Template = Template()) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(loss_mask, lambda s: template.unescaped(F.substr(formatted, s["start"] + 1, s["length"])))
