"""Chat formatting: records of many layouts become canonical turns, and turns become text.

A record is a JSON object. The paths of its nested fields, as far as any mapping names them,
are hashed to a fingerprint; the fingerprint selects a declarative mapping, and that gives
the turns. A template then writes the turns of a conversation as one text, with a loss mask,
and reads them back.

Defined results: null texts and roles are empty; a null or unreadable record, or one that no
mapping fits, has an empty list of turns and no layout, and a conversation of such records
alone an empty text; turns of a conversation come in the order of turn (nulls first), place in the record, role, text, so that ties and repeated rows
have one order; rows with a null conversation id form one conversation; fields that no
mapping names are ignored, whatever their names; an empty table gives no conversations.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prairie.llm.columns import let
from prairie.session import table

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """A layout: either one list of messages, or fields that are turns themselves.

    ``turns`` has (role, path of the text) pairs, where a role that starts with ``$`` is the
    path of a field; those in ``optional`` may be absent. ``messages`` is (path of the list,
    field of the role, field of the text). ``joined`` are paths appended to the first user
    turn after a blank line. ``roles`` renames roles.
    """

    name: str
    turns: tuple[tuple[str, str], ...] = ()
    messages: tuple[str, str, str] | None = None
    optional: tuple[str, ...] = ()
    joined: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict)

    def paths(self) -> list[str]:
        if self.messages:
            at, role, text = self.messages
            named = [f"{at}[].{role}", f"{at}[].{text}"]
        else:
            named = [p for _, p in self.turns] + [r[1:] for r, _ in self.turns if r[0] == "$"]
        return sorted({*named, *self.optional, *self.joined})

    def shapes(self) -> list[frozenset[str]]:
        """The sets of paths that select this mapping: with and without the optional ones."""
        sets = [frozenset(self.paths())]
        for path in (*self.optional, *self.joined):
            sets += [s - {path} for s in sets]
        return [s for s in sets if s]


NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant"}
MAPPINGS = (
    Mapping("messages", messages=("messages", "role", "content"), roles=NAMES),
    Mapping("exchange", messages=("conversations", "from", "value"), roles=NAMES),
    Mapping("dialog", messages=("dialog", "speaker", "utterance"), roles=NAMES),
    Mapping(
        "instruction",
        turns=(("system", "system"), ("user", "instruction"), ("assistant", "output")),
        optional=("system",),
        joined=("input",),
    ),
    Mapping("prompt_response", turns=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping("prompt_completion", turns=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("question_answer", turns=(("user", "question"), ("assistant", "answer"))),
    Mapping("nested_pair", turns=(("user", "data.prompt.text"), ("assistant", "data.response.text"))),
    Mapping("turn", turns=(("$role", "text"),)),
)


def fingerprint_of(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def field_paths(record: Column) -> Column:
    """Sorted paths of the fields of a variant that are no objects: ``a.b``, ``list[].c``.

    The schema of the value is read token by token; a stack holds the path so far.
    """
    schema = F.schema_of_variant(record)
    tokens = F.regexp_extract_all(schema, F.lit(r"(OBJECT<|ARRAY<|>|`(?:[^`]|``)*`: |[^\s:<>,`]+: )"), F.lit(1))
    start = F.struct(
        F.array(F.lit("")).alias("stack"), F.array().cast("array<string>").alias("found"), F.lit("").alias("at")
    )

    def step(acc: Column, token: Column) -> Column:
        top = F.element_at(acc.stack, -1)
        name = F.regexp_replace(token, r"^`|`?: $", "")
        path = F.concat(top, F.when(top == "", F.lit("")).otherwise(F.lit(".")), name)
        opened = F.when(token == "ARRAY<", F.concat(acc["at"], F.lit("[]"))).otherwise(acc["at"])
        closing = token == ">"
        opening = token.isin("OBJECT<", "ARRAY<")
        return F.struct(
            F.when(opening, F.concat(acc.stack, F.array(opened)))
            .when(closing, F.slice(acc.stack, 1, F.size(acc.stack) - 1))
            .otherwise(acc.stack)
            .alias("stack"),
            # A field counts once it turns out to be a leaf: it is added, and taken back if it opens.
            F.when(opening, F.array_remove(acc.found, acc["at"]))
            .when(closing, acc.found)
            .otherwise(F.array_append(acc.found, path))
            .alias("found"),
            F.when(opening, opened).when(closing, F.lit("")).otherwise(path).alias("at"),
        )

    return F.sort_array(F.array_distinct(F.aggregate(tokens, start, step, lambda acc: acc.found)))


def fingerprint(paths: Column, mappings=MAPPINGS) -> Column:
    """Hash of the paths that any mapping names; other fields do not change it."""
    known = sorted({p for m in mappings for p in m.paths()})
    return F.sha2(F.array_join(F.array_intersect(paths, F.array(*map(F.lit, known))), "\n"), 256)


def _get(record: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(record, "$." + path, kind)


def _renamed(role: Column, roles: dict[str, str]) -> Column:
    return reduce(lambda acc, kv: F.when(role == kv[0], F.lit(kv[1])).otherwise(acc), roles.items(), role)


def _turns(record: Column, m: Mapping) -> Column:
    blank = lambda c: F.coalesce(c, F.lit(""))
    turn = lambda role, text: F.struct(blank(role).alias("role"), blank(text).alias("text"))
    if m.messages:
        at, role, text = m.messages
        items = _get(record, at, f"array<struct<`{role}`:string,`{text}`:string>>")
        given = F.transform(items, lambda x: turn(_renamed(x[role], m.roles), x[text]))
    else:
        parts = []
        for role, path in m.turns:
            body = _get(record, path)
            if role == "user":
                for more in m.joined:
                    extra = _get(record, more)
                    body = F.when(F.length(extra) > 0, F.concat(blank(body), F.lit("\n\n"), extra)).otherwise(body)
            who = _renamed(_get(record, role[1:]), m.roles) if role[0] == "$" else F.lit(role)
            made = turn(who, body)
            parts.append(F.when(body.isNotNull(), made) if path in m.optional else made)
        given = F.filter(F.array(*parts), lambda t: t.isNotNull())
    return F.coalesce(given.cast(TURNS), F.array().cast(TURNS))


def _reader(m: Mapping):
    return lambda record: _turns(record, m)


def canonical(records: DataFrame, record: str, mappings=MAPPINGS) -> DataFrame:
    """``records`` with ``fingerprint``, ``layout`` (null: none fits) and ``turns``."""
    value = F.try_parse_json(F.col(record))
    known = F.try_parse_json(F.coalesce(F.col(record), F.lit("{}")))
    rows = records.withColumn("fingerprint", F.coalesce(fingerprint(field_paths(known), mappings), F.lit("")))
    layout, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    for m in mappings:
        fits = F.col("fingerprint").isin(*map(fingerprint_of, m.shapes()))
        layout = F.when(fits, F.lit(m.name)).otherwise(layout)
        turns = F.when(fits, let(value, _reader(m))).otherwise(turns)
    return rows.withColumn("layout", layout).withColumn("turns", turns)


@dataclass(frozen=True)
class Template:
    """``open`` role newline text ``close``, for each turn.

    A control string inside a text gets a backslash after its first character, one that has
    backslashes there already gets one more; reading takes one away.
    """

    open: str = "<s>"
    close: str = "</s>"
    reserved: tuple[str, ...] = ("[INST]", "[/INST]")

    def controls(self) -> tuple[str, ...]:
        return (self.open, self.close, *self.reserved)

    def escape(self, text: Column) -> Column:
        for c in self.controls():
            text = F.regexp_replace(text, f"{re.escape(c[0])}(\\\\*{re.escape(c[1:])})", f"\\{c[0]}\\\\$1")
        return text

    def unescape(self, text: Column) -> Column:
        for c in reversed(self.controls()):
            text = F.regexp_replace(text, f"{re.escape(c[0])}\\\\(\\\\*{re.escape(c[1:])})", f"\\{c[0]}$1")
        return text

    def write(self, turns: Column) -> Column:
        """The formatted text; roles are written percent-encoded, so that they have no newline."""
        return F.array_join(
            F.transform(
                turns,
                lambda t: F.concat(F.lit(self.open), F.url_encode(t.role), F.lit("\n"), self.escape(t.text), F.lit(self.close)),
            ),
            "",
        )

    def mask(self, turns: Column, role: str = "assistant") -> Column:
        """Spans of the formatted text (code points, end exclusive) that the loss counts."""
        sized = F.transform(
            turns,
            lambda t: F.struct(
                (t.role == role).alias("on"),
                (F.length(F.url_encode(t.role)) + len(self.open) + 1).alias("head"),
                F.length(self.escape(t.text)).alias("body"),
            ),
        )
        span = "array<struct<start:bigint,end:bigint>>"
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(span).alias("spans"))

        def step(acc: Column, t: Column) -> Column:
            first = acc["at"] + t["head"]
            last = first + t["body"]
            own = F.array(F.struct(first.alias("start"), last.alias("end"))).cast(span)
            return F.struct(
                (last + len(self.close)).alias("at"),
                F.when(t["on"], F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"),
            )

        return F.aggregate(sized, start, step, lambda acc: acc["spans"])

    def read(self, formatted: Column) -> Column:
        """The turns of a formatted text."""
        parts = F.split(formatted, re.escape(self.close), -1)
        heads = F.transform(
            F.slice(parts, 1, F.size(parts) - 1),
            lambda p: F.struct(p.alias("p"), F.instr(p, "\n").alias("n")),
        )
        return F.transform(
            heads,
            lambda h: F.struct(
                F.url_decode(F.substring(h.p, F.lit(len(self.open) + 1), h.n - (len(self.open) + 1))).alias("role"),
                self.unescape(F.substring(h.p, h.n + 1, F.length(h.p))).alias("text"),
            ),
        )

    def under(self, formatted: Column, spans: Column) -> Column:
        """The unescaped texts under the mask, in order."""
        return F.transform(
            spans, lambda s: self.unescape(F.substring(formatted, (s.start + 1).cast("int"), (s.end - s.start).cast("int")))
        )


def formatted(records: DataFrame, key: str, order: str, record: str, template: Template = Template(), mappings=MAPPINGS) -> DataFrame:
    """``key``, ``formatted`` and ``loss_spans`` of every conversation.

    The turns of one conversation meet in one row, as its text is one value.
    """
    rows = canonical(records.select(F.col(key).alias("_key"), F.col(order).alias("_order"), F.col(record).alias("_record")), "_record", mappings)
    each = rows.select("_key", "_order", F.posexplode_outer("turns").alias("_place", "_turn"))
    grouped = each.groupBy("_key").agg(
        F.sort_array(F.collect_list(F.when(F.col("_turn").isNotNull(), F.struct("_order", "_place", "_turn")))).alias("_all")
    )
    turns = F.transform("_all", lambda x: x["_turn"])
    return grouped.select(
        F.col("_key").alias(key),
        template.write(turns).alias("formatted"),
        template.mask(turns).alias("loss_spans"),
    )


def digests(rows: DataFrame, key: str, template: Template = Template()) -> DataFrame:
    """What can be read back from the formatted texts and their masks."""
    text = F.col("formatted")
    back = rows.select(
        key, text, template.read(text).alias("_turns"), F.array_join(template.under(text, F.col("loss_spans")), "").alias("_loss")
    )
    lines = F.array_join(F.transform("_turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return back.select(
        key,
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


PROBE = "</s>[INST] ok [/INST]"


def op2_chat(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    probe = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.lit(0).cast("long").alias("turn"),
        F.to_json(F.struct(F.lit(PROBE).alias("prompt"), F.lit(PROBE).alias("response"))).alias("record"),
    )
    return digests(formatted(rows.unionByName(probe), "conv_id", "turn", "record"), "conv_id")


QUERIES = {"op2_chat": op2_chat}
SQL = {
    "op2_chat": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_replace(regexp_replace(text, '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g')) AS n FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(8 + length(role) + n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
}
