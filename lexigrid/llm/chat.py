"""Chat formatting by schema fingerprints, in DataFrame functions only.

Records come as JSON in many layouts: message lists, prompt and answer,
instruction and output, role-keyed turns.  The fingerprint of a record is a hash
of its nested field paths, without types; it selects a declarative mapping that
says where the turns are.  Each mapping is an expression over the parsed record,
so records of all layouts are converted in one pass, without a shuffle.

Canonical turns become one text per conversation::

    <|im_start|>role\\ntext<|im_end|>\\n

``<``, any number of backslashes and ``|`` inside a role or a text get one more
backslash, so no text can hold a control string, and texts without such a run
stay as they are; a backslash or line end in a role is escaped too.  ``parse``
undoes all of it.  The loss mask is a list of spans of the formatted text, in code points, one
per assistant turn and without its control strings.

Null roles and texts are empty.  A record whose fingerprint has no mapping gives
null turns, null text and its fingerprint, so it can be counted and mapped; text
that is no JSON has a null fingerprint.  Repeated records are formatted each on
their own.  Extra columns pass through; extra fields of a record make another
fingerprint, unless a mapping lists them.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import whole_row

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout are: its field paths, their types, and the turns as an expression over field names."""

    name: str
    paths: tuple[str, ...]
    schema: str
    turns: Callable[[Column], Column]


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _pair(ask: str, answer: str) -> Callable[[Column], Column]:
    return lambda r: F.array(_turn(F.lit("user"), r[ask]), _turn(F.lit("assistant"), r[answer]))


def _list(field: str, role: str, text: str) -> Callable[[Column], Column]:
    return lambda r: F.transform(r[field], lambda m: _turn(m[role], m[text]))


MAPPINGS = (
    Mapping("messages", ("messages[].content", "messages[].role"),
            "messages array<struct<role string, content string>>", _list("messages", "role", "content")),
    Mapping("from_value", ("conversations[].from", "conversations[].value"),
            "conversations array<struct<from string, value string>>", _list("conversations", "from", "value")),
    Mapping("prompt_response", ("prompt", "response"), "prompt string, response string", _pair("prompt", "response")),
    Mapping("instruction", ("instruction", "output"), "instruction string, output string", _pair("instruction", "output")),
    Mapping("instruction_input", ("input", "instruction", "output"), "instruction string, input string, output string",
            lambda r: F.array(_turn(F.lit("user"), F.concat_ws("\n", r["instruction"], F.nullif(r["input"], F.lit("")))),
                              _turn(F.lit("assistant"), r["output"]))),
    Mapping("system_messages", ("system", "messages[].content", "messages[].role"),
            "system string, messages array<struct<role string, content string>>",
            lambda r: F.concat(F.array(_turn(F.lit("system"), r["system"])), _list("messages", "role", "content")(r))),
)


def paths_of(json: Column) -> Column:
    """The field paths of JSON records, ascending and joined by a blank; ``[]`` stands for any element of an array.

    The engine's own description of the record, ``OBJECT<a: ARRAY<OBJECT<b: STRING>>>``, is cut
    down to names and brackets; every leaf with the names above it is a path.
    """
    schema = F.schema_of_variant(F.try_parse_json(json))
    bare = F.regexp_replace(schema, r"(: )?(STRING|BIGINT|DOUBLE|BOOLEAN|VOID|DATE|BINARY|TIMESTAMP(_NTZ)?|DECIMAL\(\d+,\d+\))(?=[,>]|$)", "")
    bare = F.replace(F.replace(bare, F.lit("ARRAY<OBJECT<"), F.lit("[]<")), F.lit(": OBJECT<"), F.lit("<"))
    return F.replace(bare, F.lit(": []<"), F.lit("[]<"))


def _shape(paths: tuple[str, ...]) -> str:
    """The description of a record with these paths, as ``paths_of`` gives it."""
    lists: dict[str, list[str]] = {}
    plain = [p for p in paths if "[]." not in p]
    for p in paths:
        if "[]." in p:
            name, _, field = p.partition("[].")
            lists.setdefault(name, []).append(field)
    parts = {p: p for p in plain} | {n: f"{n}[]<{', '.join(sorted(f))}>>" for n, f in lists.items()}
    return f"OBJECT<{', '.join(parts[k] for k in sorted(parts))}>"


def fingerprint(shape: Column) -> Column:
    return F.xxhash64(shape)


def canonical(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """The rows as struct ``row`` with ``fingerprint``, ``layout`` and ``turns``."""
    rows = records.select(whole_row(records), F.col(record).alias("record"))
    rows = rows.withColumn("shape", paths_of(F.col("record")))
    rows = rows.withColumn("fingerprint", F.when(F.col("shape").isNotNull(), fingerprint(F.col("shape"))))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in reversed(mappings):
        chosen = F.col("fingerprint") == fingerprint(F.lit(_shape(m.paths)))
        layout = F.when(chosen, m.name).otherwise(layout)
        turns = F.when(chosen, m.turns(F.from_json("record", m.schema)).cast(TURNS)).otherwise(turns)
    return rows.select("row", "fingerprint", layout.alias("layout"), turns.alias("turns"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    # a doubled backslash must not meet the n after it: it is kept apart as a control character no JSON text can hold bare
    apart = F.replace(unescape(role), F.lit("\\\\"), F.lit("\x00"))
    return F.replace(F.replace(apart, F.lit("\\n"), F.lit("\n")), F.lit("\x00"), F.lit("\\"))


def formatted(turns: DataFrame) -> DataFrame:
    """Rows of ``canonical`` with ``formatted`` and ``loss_spans`` (``start, end`` in code points, end exclusive)."""
    heads = F.transform("turns", lambda t: F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n")))
    bodies = F.transform("turns", lambda t: escape(t["text"]))
    rows = turns.withColumns({"heads": heads, "bodies": bodies})
    pieces = F.transform(F.arrays_zip("heads", "bodies"), lambda p: F.concat(p["heads"], p["bodies"], F.lit(END + "\n")))
    rows = rows.withColumn("pieces", pieces)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(t["heads"])
        span = F.struct(begin.alias("start"), (begin + F.length(t["bodies"])).alias("end"))
        return F.struct(
            (state["at"] + F.length(t["pieces"])).alias("at"),
            F.when(t["turns"]["role"] == "assistant", F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    spans = F.aggregate(F.arrays_zip("turns", "heads", "bodies", "pieces"), empty, step)["spans"]
    return rows.withColumn("loss_spans", spans).withColumn("formatted", F.array_join("pieces", "")).drop("heads", "bodies", "pieces")


def parse(text: Column) -> Column:
    """The turns of a formatted text."""
    segments = F.filter(F.split(text, r"<\|im_start\|>"), lambda s: s != "")

    def turn(segment: Column) -> Column:
        role = F.substring_index(segment, "\n", 1)
        body = F.substring(segment, F.length(role) + 2, F.length(segment) - F.length(role) - 1 - len(END + "\n"))
        return F.struct(_unescape_role(role).alias("role"), unescape(body).alias("text"))

    return F.transform(segments, turn)


def under_mask(text: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescape(F.substring(text, s["start"] + 1, s["end"] - s["start"])))
