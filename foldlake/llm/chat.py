"""Chat formatting: records of many layouts become canonical turns and then one marked text with a loss mask.

The nested field paths of a record are hashed to its schema fingerprint, which selects a declarative mapping (Layout):
that of the most required paths, all of which the record has. Other fields are allowed.
The text marks turns with control strings; control strings inside roles and texts are escaped reversibly.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlake.llm import common

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of known chat templates; fixed values. None may stand unescaped in a text.
CONTROLS = (START, MIDDLE, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|end|>", "<|eot_id|>",
            "<|start_header_id|>", "<|end_header_id|>", "<|begin_of_text|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>",
            "<</SYS>>", "<pad>", "<unk>", "<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>")
_CONTROL = re.compile("(?=(?:" + "|".join(map(re.escape, CONTROLS)) + "))(.)", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_PARTS = re.compile(f"{re.escape(START)}(.*?){re.escape(MIDDLE)}(.*?){re.escape(END)}", re.S)
LEARNED = "assistant"


def escape(text: str) -> str:
    """text with each backslash doubled and a backslash after the first character of each control string."""
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Layout:
    """How records of one layout become turns.

    turns is the path of the list of messages, whose role and text fields are named, and fields lists what stands before
    them; or turns is empty and fields lists pairs of role and field, in order. Fields in optional may be absent; empty
    optional texts give no turn. roles renames roles.
    """

    name: str
    turns: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    def required(self) -> frozenset[str]:
        """The field paths that a record of this layout has, an empty list of messages apart."""
        fields = {field for _, field in self.fields} - set(self.optional)
        return frozenset(fields | ({self.turns, f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"} if self.turns else set()))


_NAMES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
_SYSTEM = (("system", "system"),)
LAYOUTS = (
    Layout("messages", "messages", "role", "content", _SYSTEM, ("system",)),
    Layout("sharegpt", "conversations", "from", "value", _SYSTEM, ("system",), _NAMES),
    Layout("conversation", "conversation", "role", "content", _SYSTEM, ("system",), _NAMES),
    Layout("dialogue", "dialogue", "speaker", "utterance", roles=_NAMES),
    Layout("prompt", fields=(*_SYSTEM, ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Layout("response", fields=(*_SYSTEM, ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Layout("question", fields=(*_SYSTEM, ("user", "question"), ("assistant", "answer")), optional=("system",)),
    Layout(
        "instruction",
        fields=(*_SYSTEM, ("user", "instruction"), ("user", "input"), ("assistant", "output")),
        optional=("system", "input"),
    ),
)


def paths(value, at: str = "") -> Iterator[str]:
    """The nested field paths of a JSON value; list elements share the path `[]`."""
    if at:
        yield at
    if isinstance(value, dict):
        for key, inner in value.items():
            yield from paths(inner, f"{at}.{key}" if at else key)
    elif isinstance(value, list):
        for inner in value:
            yield from paths(inner, f"{at}[]")


def fingerprint(fields: set[str] | frozenset[str]) -> int:
    return xxhash.xxh64_intdigest("\n".join(sorted(fields))) - (1 << 63)


class Mappings(dict):
    """Layouts (or None) by fingerprint, of the schemas met so far, up to a bound."""

    MOST = 10_000

    def of(self, mark: int, fields: set[str]) -> Layout | None:
        if mark not in self:
            if len(self) >= self.MOST:
                self.clear()
            fits = [x for x in LAYOUTS if x.required() <= fields or x.turns and x.turns in fields and f"{x.turns}[]" not in fields]
            self[mark] = max(fits, key=lambda x: len(x.required()), default=None)
        return self[mark]


@lru_cache(1)
def mappings() -> Mappings:
    return Mappings()


def text_of(value) -> str:
    """The text of a field: of a list of parts their texts one after the other, of other parts (images) none."""
    if isinstance(value, str):
        return value
    if value is None:
        return ""
    if isinstance(value, list):
        return "".join(map(text_of, value))
    if isinstance(value, dict):
        return text_of(value.get("text"))
    return json.dumps(value)


def turns_of(record: dict, layout: Layout) -> list[tuple[str, str]]:
    """The canonical turns of a record; null roles and texts are empty, and what stands among messages but is none is a
    text without role."""
    renamed = dict(layout.roles)
    out: list[tuple[str, str]] = []
    for role, field in layout.fields:
        text = text_of(record.get(field))
        if field in layout.optional and not text:
            continue
        if out and out[-1][0] == role:
            out[-1] = (role, f"{out[-1][1]}\n\n{text}")
        else:
            out.append((role, text))
    if layout.turns:
        messages = record[layout.turns]
        for m in messages if isinstance(messages, list) else []:
            role, text = (text_of(m.get(layout.role)), text_of(m.get(layout.text))) if isinstance(m, dict) else ("", text_of(m))
            out.append((renamed.get(role, role), text))
    return out


def render(turns: list[tuple[str, str]]) -> tuple[str, list[int]]:
    """The marked text, and the loss mask: start and end of each learned text in code points."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{MIDDLE}", escape(text)
        parts += [head, body, END]
        if role == LEARNED:
            mask += [at + len(head), at + len(head) + len(body)]
        at += len(head) + len(body) + len(END)
    return "".join(parts), mask


def read_turns(text: str) -> list[tuple[str, str]]:
    """The turns of a marked text."""
    return [(unescape(role), unescape(body)) for role, body in _PARTS.findall(text)]


def format_records(records: DataFrame) -> DataFrame:
    """conv_id, fingerprint, layout, n_turns, formatted, loss_mask for records of conv_id and record (JSON objects).

    A record whose fingerprint selects no layout, and one that is null or no JSON object, stays with a null layout and
    an empty text. Rows are handled singly, so repeated ids are no matter.
    """

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = mappings()
        for batch in batches:
            out = []
            for text in batch["record"].to_pylist():
                try:
                    record = json.loads(text or "null")
                except ValueError:
                    record = None
                fields = set(paths(record)) if isinstance(record, dict) else set()
                mark = fingerprint(fields) if isinstance(record, dict) else None
                layout = known.of(mark, fields) if fields else None
                turns = turns_of(record, layout) if layout else []
                out.append((mark, layout.name if layout else None, len(turns), *render(turns)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.int32()))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], *columns], names=["conv_id", "fingerprint", "layout", "n_turns", "formatted", "loss_mask"]
            )

    common.small_batches(records.sparkSession)
    schema = "conv_id long, fingerprint long, layout string, n_turns long, formatted string, loss_mask array<int>"
    return records.select(F.col("conv_id").cast("long"), "record").mapInArrow(formatted, schema)


def records_of(rows: DataFrame) -> DataFrame:
    """conv_id and record from rows of single turns (conv_id, turn, role, text), in three layouts chosen by the id's crc32:
    messages, messages whose contents are lists of parts, and from/value pairs.

    Turns are ordered by turn, then role and text, nulls first; repeated turns stay. A null conv_id is a conversation of
    its own. Conversations with a role that the third layout renames are messages. The turns of one conversation meet in
    one row, as it is one record.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    groups = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    part = lambda text: F.array(F.struct(F.lit("text").alias("type"), text.alias("text")))
    plain = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    parts = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), part(t["content"]).alias("content")))
    pairs = F.transform("turns", lambda t: F.struct(t["role"].alias("from"), t["content"].alias("value")))
    kind = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 3, F.lit(0))
    renamed = F.exists("turns", lambda t: t["role"].isin([name for name, _ in _NAMES]))

    def json_of(name: str, value: Column) -> Column:
        return F.to_json(F.struct(F.col("conv_id").alias("id"), value.alias(name)), {"ignoreNullFields": "false"})

    record = F.when((kind == 1), json_of("messages", parts)).when((kind == 2) & ~renamed, json_of("conversations", pairs))
    return groups.select("conv_id", record.otherwise(json_of("messages", plain)).alias("record"))


def digests(formatted: DataFrame) -> DataFrame:
    """What the marked texts hold, read back from them: the columns of op7's contract."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, text, mask in zip(*(batch[c].to_pylist() for c in ("conv_id", "formatted", "loss_mask")), strict=True):
                turns = read_turns(text)
                learned = unescape("".join(text[a:b] for a, b in zip(mask[::2], mask[1::2], strict=True)))
                whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                sha = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, learned)]
                out.append((conv, len(turns), sha[0], len(learned), sha[1], len(text)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(read, schema)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns and their digests, read back from the formatted conversations and one made conversation, -1. Null texts are
    empty; columns beside conv_id, turn, role and text are not read."""
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    records = records_of(rows.unionByName(probe))
    return digests(common.materialize(format_records(records), "chat"))
