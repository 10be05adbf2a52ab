"""Operator 8, chat formatting by schema fingerprint; DataFrame functions only.

A record is a JSON object, or a struct column, in any known layout. Its fingerprint is the hash
of its nested field paths (names and nesting, not the types of leaves). The fingerprint
selects a layout's mapping, an expression that yields canonical turns (role, text). A struct's
paths are those of the table's schema, so its rows are read as they are, with no JSON on the way
and no limit but that of a Spark string (2 GiB, escapes included).
A layout states the fields it needs and those it may also have; each such set of
fields has its own fingerprint.

Template: ``<|start|>role\\ntext<|end|>\\n``. Inside role and text ``&``, ``<`` and ``[``
are written ``&amp;``, ``&lt;`` and ``&lbrack;`` (in a role also a line end as
``&newline;``), so neither these marks nor other templates' control strings can come
from a text, and reading undoes it exactly. The loss mask is the text of assistant turns.

Scale: formatting, masks and reading work turn by turn, with no shuffle; layouts are a
small fixed table. Only ``conversation_digests`` gathers a conversation, because a hash
over its whole text must.

Defined cases: null text and null role are empty; a JSON record whose layout is unknown,
that is no JSON object, or that Spark's JSON parser refuses (a string of over 20,000,000
characters, for one) gives no turns and is returned by ``unknown_records``; structs of an unknown
layout are an error, a null struct gives no turns; null turn numbers come first; turns with the
same number are ordered by place in the record, role and text; repeated rows are
repeated turns; a null conv_id is one conversation; extra columns are ignored.
"""

from __future__ import annotations

import json
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .common import cut_lineage

START, END = "<|start|>", "<|end|>\n"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lbrack;"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&newline;"))

_TURNS = "array<struct<role:string,text:string>>"


def _pair(role: str, text: str) -> str:
    return f"named_struct('role', {role}, 'text', coalesce({text}, ''))"


def _get(path: str) -> str:
    return f"try_variant_get(v, '$.{path}', 'string')"


def _list(path: str, *fields: str) -> str:
    return f"try_variant_get(v, '$.{path}', 'array<struct<{','.join(f'{f}:string' for f in fields)}>>')"


def _listed(items: str, role: str, text: str, role_of: str = "m.r") -> str:
    """Turns out of a list of objects."""
    return f"transform({items}, m -> {_pair(role_of.replace('m.r', f'm.{role}'), f'm.{text}')})"


def _spoken(role: str) -> str:
    return f"case {role} when 'human' then 'user' when 'gpt' then 'assistant' else {role} end"


#: name -> (example with the needed fields, further fields it may have, mapping to turns by the ways to get a field and a list)
LAYOUTS = {
    "turn": ({"role": "", "text": ""}, [], lambda get, rows: f"array({_pair(get('role'), get('text'))})"),
    "message": ({"role": "", "content": ""}, ["name"], lambda get, rows: f"array({_pair(get('role'), get('content'))})"),
    "messages": ({"messages": [{"role": "", "content": ""}]}, ["id"],
                 lambda get, rows: _listed(rows("messages", "role", "content"), "role", "content")),
    "spoken": ({"conversations": [{"from": "", "value": ""}]}, ["id"],
               lambda get, rows: _listed(rows("conversations", "from", "value"), "from", "value", _spoken("m.r"))),
    "prompt": ({"prompt": "", "completion": ""}, [],
               lambda get, rows: f"array({_pair(repr('user'), get('prompt'))}, {_pair(repr('assistant'), get('completion'))})"),
    "prompt_response": ({"prompt": "", "response": ""}, ["system"],
                        lambda get, rows: f"concat(if({get('system')} is null, cast(array() as {_TURNS}),"
                                          f" array({_pair(repr('system'), get('system'))})),"
                                          f" array({_pair(repr('user'), get('prompt'))}, {_pair(repr('assistant'), get('response'))}))"),
    "instruction": ({"instruction": "", "output": ""}, ["input"],
                    lambda get, rows: "array(" + _pair(repr("user"), f"concat({get('instruction')}, if(coalesce({get('input')}, '') = '', '',"
                                                       f" concat('\\n', {get('input')})))") + f", {_pair(repr('assistant'), get('output'))})"),
}


def fingerprint(variant: Column) -> Column:
    """Hash of the nested field paths: the record's schema without its leaf types."""
    shape = F.regexp_replace(F.schema_of_variant(variant), r": (?!OBJECT<|ARRAY<)[A-Z]+(\([0-9,]*\))?", "")
    return F.xxhash64(F.regexp_replace(shape, r"ARRAY<(?!OBJECT<|ARRAY<)[A-Z]+>", "ARRAY<>"))


def layout_table(spark) -> DataFrame:
    """(fingerprint, layout): one row for each set of fields a layout may have."""
    rows = []
    for name, (needed, also, _) in LAYOUTS.items():
        for n in range(len(also) + 1):
            for extra in combinations(also, n):
                rows.append(F.struct(F.lit(name).alias("layout"), F.lit(json.dumps({**needed, **dict.fromkeys(extra, "")})).alias("j")))
    table = spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return table.select(fingerprint(F.parse_json("j")).alias("fingerprint"), "layout")


def _matched(records: DataFrame) -> DataFrame:
    rows = records.withColumn("v", F.try_parse_json("record"))
    rows = rows.withColumn("fingerprint", F.when(F.col("v").isNotNull(), fingerprint(F.col("v"))))
    return rows.join(F.broadcast(layout_table(records.sparkSession)), "fingerprint", "left")


def canonical_turns(records: DataFrame) -> DataFrame:
    """conv_id, turn, part, role, text from (conv_id, turn, record)."""
    turns = F.lit(None).cast(_TURNS)
    for name, (_, _, mapping) in LAYOUTS.items():
        turns = F.when(F.col("layout") == name, F.expr(f"cast({mapping(_get, _list)} as {_TURNS})")).otherwise(turns)
    return _turn_rows(_matched(records.select("conv_id", "turn", "record")), turns)


def _turn_rows(rows: DataFrame, turns: Column) -> DataFrame:
    return rows.select("conv_id", "turn", F.posexplode(turns).alias("part", "t")).select(
        "conv_id", "turn", "part", F.coalesce("t.role", F.lit("")).alias("role"), F.coalesce("t.text", F.lit("")).alias("text"))


def _shape(kind) -> str:
    """A type's nested field paths, written as ``fingerprint`` has them."""
    if isinstance(kind, ArrayType):
        return f"ARRAY<{_shape(kind.elementType)}>"
    if not isinstance(kind, StructType):
        return ""
    fields = [(f.name, _shape(f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)]
    return f"OBJECT<{', '.join(f'{name}: {shape}' if shape else name for name, shape in fields)}>"


def canonical_rows(rows: DataFrame) -> DataFrame:
    """As ``canonical_turns``, from (conv_id, turn, record) whose record is a struct."""
    kind = rows.schema["record"].dataType
    known = layout_table(rows.sparkSession).filter(F.col("fingerprint") == F.xxhash64(F.lit(_shape(kind)))).collect()     # one row
    if not known:
        raise ValueError(f"no layout has the fields {_shape(kind)}")

    def get(path: str) -> str:
        return f"cast(record.`{path}` as string)" if path in kind.names else "cast(null as string)"

    turns = F.expr(f"cast({LAYOUTS[known[0]['layout']][2](get, lambda path, *fields: f'record.`{path}`')} as {_TURNS})")
    return _turn_rows(rows.select("conv_id", "turn", "record"), F.when(F.col("record").isNotNull(), turns))


def unknown_records(records: DataFrame) -> DataFrame:
    return _matched(records.select("conv_id", "turn", "record")).filter("layout is null").select("conv_id", "turn", "record")


def escape(col: Column, rules=ESCAPES) -> Column:
    for plain, written in rules:
        col = F.replace(col, F.lit(plain), F.lit(written))
    return col


def unescape(col: Column, rules=ESCAPES) -> Column:
    for plain, written in reversed(rules):
        col = F.replace(col, F.lit(written), F.lit(plain))
    return col


def format_turns(turns: DataFrame) -> DataFrame:
    """Per turn: the formatted segment and its loss mask [loss_start, loss_stop) in code
    points of the segment (empty for turns that aren't the assistant's)."""
    head = F.concat(F.lit(START), escape(F.col("role"), ROLE_ESCAPES), F.lit("\n"))
    body = escape(F.col("text"))
    return turns.select("conv_id", "turn", "part", head.alias("head"), body.alias("body"), "role").select(
        "conv_id", "turn", "part", F.concat("head", "body", F.lit(END)).alias("formatted"),
        F.length("head").alias("loss_start"),
        (F.length("head") + F.when(F.col("role") == "assistant", F.length("body")).otherwise(0)).alias("loss_stop"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """The turns and the masked text, out of formatted segments alone."""
    pattern = r"(?s)^<\|start\|>([^\n<]*)\n([^<]*)<\|end\|>\n$"
    masked = F.substring("formatted", F.col("loss_start") + 1, F.col("loss_stop") - F.col("loss_start"))
    return formatted.select(
        "conv_id", "turn", "part", "formatted",
        unescape(F.regexp_extract("formatted", pattern, 1), ROLE_ESCAPES).alias("role"),
        unescape(F.regexp_extract("formatted", pattern, 2)).alias("text"), unescape(masked).alias("loss"))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    turns = read_turns(formatted).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "part", "role", "text", "loss"))).alias("t"),
        F.sum(F.length("formatted").cast("long")).alias("formatted_chars"))
    said = F.array_join(F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("t.loss", "")
    return turns.select("conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


def format_records(records: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """The written table of formatted turns, of JSON records and of ``rows`` whose record is a struct."""
    turns = canonical_turns(records)
    return cut_lineage(format_turns(turns if rows is None else turns.unionByName(canonical_rows(rows))), "formatted_turns")


SQL = r"""
with t as (
  select conv_id, turn, 0 as part, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 0, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (
  select *, length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lbrack;'), chr(10), '&newline;'))
          + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lbrack;')) + 18 as chars,
         case when role = 'assistant' then text else '' end as loss from t)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, part, role, text)) as turns_sha256,
       cast(sum(length(loss)) as bigint) as loss_chars,
       sha256(string_agg(loss, '' order by turn nulls first, part, role, text)) as loss_sha256,
       cast(sum(chars) as bigint) as formatted_chars
from e group by conv_id
"""
