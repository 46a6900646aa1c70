"""Chat formatting by schema fingerprints, in DataFrame functions only.

Records come in many layouts: a prompt and a response, an instruction with
an input, a list of messages, a row per turn.  A layout is recognised by a
hash of its nested field paths, and the hash selects a declarative mapping
(``LAYOUTS``) from those fields to canonical turns ``(turn, role, text)``.
For JSON records the hash is taken of every row; for typed columns once, of
the schema.  ``format_turns`` then writes conversations with marked turns
and a loss mask, and ``parse`` reads them back.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import whole_text

TURN = "struct<turn bigint, role string, text string>"


@dataclass(frozen=True)
class Layout:
    """How the fields of one record layout become turns.

    ``fields``: (role, field) per turn in order, or with ``each`` set: the
    list field whose elements have ``role_field`` and ``text_field``; with
    neither, the record is one turn.  ``roles`` renames roles.
    """

    name: str
    paths: tuple[str, ...]
    fields: tuple[tuple[str, str], ...] = ()
    each: str = ""
    role_field: str = ""
    text_field: str = ""
    roles: tuple[tuple[str, str], ...] = ()
    turn_field: str = ""


SPEAKERS = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
#: The layouts that are known; a caller may pass others.
LAYOUTS = (
    Layout("turn_row", ("role", "text", "turn"), role_field="role", text_field="text", turn_field="turn"),
    Layout("messages", ("messages", "messages[].content", "messages[].role"), each="messages",
           role_field="role", text_field="content", roles=SPEAKERS),
    Layout("from_value", ("conversations", "conversations[].from", "conversations[].value"), each="conversations",
           role_field="from", text_field="value", roles=SPEAKERS),
    Layout("prompt_response", ("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_completion", ("completion", "prompt"), (("user", "prompt"), ("assistant", "completion"))),
    Layout("question_answer", ("answer", "question"), (("user", "question"), ("assistant", "answer"))),
    Layout("instruction", ("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_input", ("input", "instruction", "output"),
           (("user", "instruction\n\ninput"), ("assistant", "output"))),
    Layout("system_instruction", ("input", "instruction", "output", "system"),
           (("system", "system"), ("user", "instruction\n\ninput"), ("assistant", "output"))),
)


# ----------------------------------------------------------- fingerprints
#: Names that Spark gives to the types of JSON's plain values.
PLAIN = r"(STRING|VOID|BIGINT|DOUBLE|FLOAT|BOOLEAN|DECIMAL\(\d+, ?\d+\)|VARIANT|DATE|TIMESTAMP\w*|BINARY)"


def shape(paths: tuple[str, ...]) -> str:
    """One text for a set of nested field paths, whatever their order:
    ``OBJECT<messages: ARRAY<OBJECT<content: x, role: x>>>``."""
    tree: dict = {}
    for path in paths:
        node = tree
        for step in path.split("."):
            node = node.setdefault(step.removesuffix("[]"), {})
            if step.endswith("[]"):
                node = node.setdefault("[]", {})

    def show(node: dict) -> str:
        if "[]" in node:
            return f"ARRAY<{show(node['[]'])}>"
        return f"OBJECT<{', '.join(f'{k}: {show(v)}' for k, v in sorted(node.items()))}>" if node else "x"

    return show(tree)


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """The nested field paths of a type; ``[]`` marks list elements."""
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, at + "[]") or [at + "[]"]
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for here in [f"{at}.{f.name}" if at else f.name]
                for p in [here, *schema_paths(f.dataType, here)]]
    return []


def json_fingerprint(record: Column) -> Column:
    """Hash of a JSON text's nested field paths: of the shape of its schema,
    in which Spark sorts the fields of objects and merges the elements of
    lists.  Null for a null and for what isn't JSON."""
    kind = F.schema_of_variant(F.try_parse_json(record))
    return F.when(kind.isNotNull(), F.xxhash64(F.regexp_replace(kind, f"(^|: |ARRAY<){PLAIN}", "$1x")))


def _fingerprint(paths: tuple[str, ...]) -> Column:
    return F.xxhash64(F.lit(shape(paths)))


def _role(layout: Layout, role: Column) -> Column:
    for old, new in layout.roles:
        role = F.when(role == old, F.lit(new)).otherwise(role)
    return role


def _turns(layout: Layout, get, get_list) -> Column:
    """The turns of a record; ``get(field)`` is a text, ``get_list(field)`` a
    list of (role, text)."""
    if layout.each:
        return F.transform(get_list(layout.each, layout.role_field, layout.text_field),
                           lambda m, i: F.struct(i.cast("bigint").alias("turn"), _role(layout, m["role"]).alias("role"),
                                                 m["text"].alias("text")))
    if layout.fields:
        made = []
        for i, (role, fields) in enumerate(layout.fields):
            # several fields of a turn are joined by an empty line, empty ones left out
            texts = [F.when(get(f) != "", get(f)) for f in fields.split("\n\n")]
            made.append(F.struct(F.lit(i).cast("bigint").alias("turn"), F.lit(role).alias("role"),
                                 F.concat_ws("\n\n", *texts).alias("text")))
        return F.array(*made)
    return F.array(F.struct(get(layout.turn_field).cast("bigint").alias("turn"),
                            _role(layout, get(layout.role_field)).alias("role"), get(layout.text_field).alias("text")))


def canonical_json(records: DataFrame, id_col: str, record_col: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``id_col``, ``layout``, ``turns`` per row of JSON texts.  A record of
    an unknown layout, a null and what isn't JSON (or is beyond the size
    limit of Spark's variant type) are kept, with layout and turns null."""
    row = records.select(F.col(id_col).alias("_id"), F.col(record_col).alias("_r")).withColumn("_h", json_fingerprint(F.col("_r")))
    value = F.try_parse_json("_r")

    def get(field: str) -> Column:
        return F.try_variant_get(value, f"$.{field}", "string")

    def get_list(field: str, role: str, text: str) -> Column:
        return F.transform(F.try_variant_get(value, f"$.{field}", f"array<struct<`{role}`:string,`{text}`:string>>"),
                           lambda m: F.struct(m[role].alias("role"), m[text].alias("text")))

    name, turns = F.lit(None).cast("string"), F.lit(None).cast(f"array<{TURN}>")
    for x in reversed(layouts):
        same = F.col("_h") == _fingerprint(x.paths)
        name, turns = F.when(same, F.lit(x.name)).otherwise(name), F.when(same, _turns(x, get, get_list)).otherwise(turns)
    return row.select(F.col("_id").alias(id_col), name.alias("layout"), turns.alias("turns"))


def canonical_typed(records: DataFrame, id_col: str, record_cols: list[str], layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """As ``canonical_json`` for typed columns: the schema of ``record_cols``
    is hashed once for all rows.  An unknown layout raises ValueError."""
    row = records.select(F.col(id_col).alias("_id"), F.struct(*record_cols).alias("_r"))
    paths = tuple(schema_paths(row.schema["_r"].dataType))
    own, *known = records.sparkSession.range(1).select(_fingerprint(paths), *[_fingerprint(x.paths) for x in layouts]).first()
    if own not in known:
        raise ValueError(f"no layout has the field paths {paths}")
    layout = layouts[known.index(own)]

    def get_list(field: str, role: str, text: str) -> Column:
        return F.transform(F.col("_r")[field], lambda m: F.struct(m[role].cast("string").alias("role"), m[text].cast("string").alias("text")))

    return row.select(F.col("_id").alias(id_col), F.lit(layout.name).alias("layout"),
                      _turns(layout, lambda f: F.col("_r")[f].cast("string"), get_list).alias("turns"))


# -------------------------------------------------------------- formatting
HEAD, END = "### ", "</turn>\n"
#: What stands for the escape character and for the first characters of control strings.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))


def escape(text: Column) -> Column:
    """No ``#`` or ``<``, thus no control string, is left in the text."""
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """The codes are taken back with that of the escape character last: each
    backslash of an escaped text begins exactly one code."""
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_turns(turns: DataFrame, id_col: str, learn_role: str = "assistant") -> DataFrame:
    """Conversations from canonical turns in rows (``turn``, ``role``,
    ``text``): ``id_col``, ``n_turns``, ``formatted``, ``loss_mask`` (per
    turn), ``loss_spans`` (start and length in code points of each learned
    text in ``formatted``).

    Turns are ordered by number, then role and text, so ties and repeated
    rows have one order; a null role or text is empty.  A newline in a role
    is escaped as well, as it ends the head.
    """
    role = F.replace(escape(whole_text("role")), F.lit("\n"), F.lit("\\n"))
    row = turns.select(F.col(id_col).alias("_id"), "turn", role.alias("role"), escape(whole_text("text")).alias("text"),
                       (whole_text("role") == learn_role).alias("learn"))
    row = row.withColumn("head", F.concat(F.lit(HEAD), "role", F.lit("\n")))
    size = F.length("head") + F.length("text") + len(END)
    before = Window.partitionBy("_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    row = row.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    parts = row.groupBy("_id").agg(F.array_sort(F.collect_list(
        F.struct("turn", "role", "text", "start", "head", "learn"))).alias("p"))
    return parts.select(
        F.col("_id").alias(id_col), F.size("p").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["text"], F.lit(END))), "").alias("formatted"),
        F.transform("p", lambda x: x["learn"]).alias("loss_mask"),
        F.transform(F.filter("p", lambda x: x["learn"]), lambda x: F.struct(
            x["start"], F.length(x["text"]).cast("bigint").alias("length"))).alias("loss_spans"))


def parse(formatted: DataFrame, id_col: str) -> DataFrame:
    """``id_col``, ``turns`` (role, text, learn), ``formatted_chars`` read
    back from ``formatted`` and ``loss_mask``."""
    pieces = F.slice(F.split("formatted", re.escape(END)), F.lit(1), F.size("loss_mask"))

    def turn(piece: Column, i: Column) -> Column:
        at = F.locate("\n", piece)
        role = F.replace(F.substring(piece, F.lit(len(HEAD) + 1), at - len(HEAD) - 1), F.lit("\\n"), F.lit("\n"))
        return F.struct(unescape(role).alias("role"), unescape(F.substring(piece, at + 1, F.length(piece))).alias("text"),
                        F.col("loss_mask")[i].alias("learn"))

    return formatted.select(id_col, F.transform(pieces, turn).alias("turns"),
                            F.length("formatted").cast("bigint").alias("formatted_chars"))


def digests(parsed: DataFrame, id_col: str) -> DataFrame:
    """Digests of what was read back, per conversation."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: t["text"]), "")
    return parsed.select(id_col, F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                         F.length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
                         "formatted_chars")
