"""Chat formatting of records in mixed layouts, chosen by schema fingerprints.

A record is a JSON object.  The paths of its fields (``a.b`` for an object in an
object, ``a[]`` for the members of an array) are sorted and hashed: the
fingerprint.  It selects a mapping, a declaration of where the turns are: a list
of turns with the names of role and text, or fields with the roles they stand
for.  A mapping declares required and optional paths, so it is listed under the
fingerprints of all their combinations, and a record is mapped by one look-up.
Records of an unknown layout are returned as such, with their fingerprint.

Turns are written as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Control strings in
texts are escaped: ``<|`` gets a backslash between its signs, and one more where
there are some already, so that it can be taken back and no text holds ``<|``.
The loss mask is the span of an assistant's text.

A conversation is a group of records or one record with several turns.  Turns
are sorted by conversation and order and streamed, with a few running digests
per conversation, so memory does not grow with a conversation's length; its
digest is by its nature computed in one place.

A null or absent text is empty, a null role is the empty role; turns without an
order come first; turns with the same order are ordered by role and text, and
repeated rows are repeated turns.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import chain, combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def field_paths(value, at: str = "") -> set[str]:
    """Paths of all leaves of a JSON value."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(field_paths(v, f"{at}[]") for v in value))
    return {at}


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """Where a layout has its turns.

    ``turns`` lists (role, paths): a fixed role and the fields whose texts, joined
    by an empty line, are the turn; turns without any text are left out.  ``each``
    names an array of turns with the fields of role and text instead, or is "" for
    a record that is one turn.  ``roles`` translates role names.
    """

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: str | None = None
    role: str = "role"
    text: str = "content"
    order: str | None = None
    roles: dict = field(default_factory=dict, hash=False)

    def fingerprints(self) -> set[str]:
        subsets = chain.from_iterable(combinations(self.optional, n) for n in range(len(self.optional) + 1))
        return {fingerprint({*self.required, *more}) for more in subsets}


ROLES = {"human": "user", "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT, "prompter": "user"}
# Paths that identify a record and say nothing about its layout.
IGNORED = ("conv_id", "id", "source", "lang")
MAPPINGS = (
    Mapping("turn rows", ("role", "text", "turn"), each="", text="text", order="turn"),
    Mapping("messages", ("messages[].role", "messages[].content"), each="messages", roles=ROLES),
    Mapping("system and messages", ("system", "messages[].role", "messages[].content"), turns=(("system", ("system",)),), each="messages", roles=ROLES),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), each="conversations", role="from", text="value", roles=ROLES),
    Mapping("prompt", ("prompt", "response"), ("system",), (("system", ("system",)), ("user", ("prompt",)), (ASSISTANT, ("response",)))),
    Mapping("completion", ("prompt", "completion"), (), (("user", ("prompt",)), (ASSISTANT, ("completion",)))),
    Mapping("instruction", ("instruction", "output"), ("input", "system"), (("system", ("system",)), ("user", ("instruction", "input")), (ASSISTANT, ("output",)))),
    Mapping("question", ("question", "answer"), ("context",), (("user", ("context", "question")), (ASSISTANT, ("answer",)))),
    Mapping("nested prompt", ("data.prompt", "data.response"), (), (("user", ("data.prompt",)), (ASSISTANT, ("data.response",)))),
)


def mapping_table(mappings: Iterable[Mapping] = MAPPINGS) -> dict[str, Mapping]:
    table: dict[str, Mapping] = {}
    for mapping in mappings:
        for mark in mapping.fingerprints():
            if table.setdefault(mark, mapping) is not mapping:
                raise ValueError(f"{mapping.name} and {table[mark].name} declare the same layout")
    return table


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _at(record: dict, path: str):
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def canonical_turns(record: dict, mapping: Mapping) -> list[tuple[object, str, str]]:
    """(order, role, text) of a record's turns."""
    out: list[tuple[object, str, str]] = []
    for role, paths in mapping.turns:
        texts = [_text(_at(record, p)) for p in paths if _at(record, p) not in (None, "")]
        if texts or role != "system":
            out.append((len(out), role, "\n\n".join(texts)))
    if mapping.each is not None:
        members = [record] if mapping.each == "" else _at(record, mapping.each) or []
        for turn in members:
            role = _text(turn.get(mapping.role))
            order = turn.get(mapping.order) if mapping.order else len(out)
            out.append((order, mapping.roles.get(role, role), _text(turn.get(mapping.text))))
    return out


def records_to_turns(records: DataFrame, record: str = "record", key: str = "conv_id") -> DataFrame:
    """(key, turn, role, text, layout, fingerprint) of JSON records.

    Records that no mapping knows, or that are no objects, have one row with a
    null layout and null role and text.
    """
    table = mapping_table()

    def run(batches):
        for batch in batches:
            at, out = [], []
            for k, source in enumerate(batch.column(record).to_pylist()):
                try:
                    value = json.loads(source) if source else None
                except ValueError:
                    value = None
                known = {p for p in field_paths(value) if p not in IGNORED} if isinstance(value, dict) else set()
                mark = fingerprint(known)
                mapping = table.get(mark)
                turns = canonical_turns(value, mapping) if mapping else [(None, None, None)]
                at += [k] * len(turns)
                out += [(*t, mapping.name if mapping else None, mark) for t in turns]
            columns = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), *[pa.string()] * 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                ["key", "turn", "role", "text", "layout", "fingerprint"],
            )

    kind = records.schema[key].dataType.simpleString()
    schema = f"key {kind}, turn long, role string, text string, layout string, fingerprint string"
    return records.select(key, record).mapInArrow(run, schema).withColumnRenamed("key", key)


_MARK = re.compile(r"<(\\*)\|")
_MARKED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No control string is left in the text; ``unescape`` takes it back."""
    return _MARK.sub(lambda m: f"<\\{m[1]}|", text)


def unescape(text: str) -> str:
    return _MARKED.sub(lambda m: f"<{m[1]}|", text)


def _role_out(role: str) -> str:
    # A role ends at the line's end.
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turns(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """The formatted turns in order, one row each: key, place, formatted, and the loss
    mask [loss_start, loss_stop) in code points of ``formatted``, null without loss."""
    def run(batches):
        now, place = object(), 0
        for batch in batches:
            keys = batch.column(key).to_pylist()
            out = []
            for k, role, text in zip(keys, batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                now, place = k, place + 1 if k == now else 0
                head = f"{START}{_role_out(role or '')}\n"
                body = escape(text or "")
                loss = (len(head), len(head) + len(body)) if role == ASSISTANT else (None, None)
                out.append((place, f"{head}{body}{END}\n", *loss))
            columns = list(zip(*out)) if out else [()] * 4
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                [key, "place", "formatted", "loss_start", "loss_stop"],
            )

    kind = turns.schema[key].dataType.simpleString()
    return (
        turns.select(key, "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition(key).sortWithinPartitions(key, "turn", "role", "text")
        .mapInArrow(run, f"{key} {kind}, place long, formatted string, loss_start long, loss_stop long")
    )


_TURN = re.compile(rf"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", re.S)


def parse_formatted(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of formatted turns."""
    return [(_role_in(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def read_back(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """Figures of each conversation, parsed from its formatted turns in order."""
    FIGURES = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

    def run(batches):
        now, state = None, None

        def done():
            return (now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in (key, "formatted", "loss_start", "loss_stop"))
            for k, text, start, stop in zip(*columns):
                if now != (k,):
                    if now:
                        out.append(done())
                    now, state = (k,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse_formatted(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode("utf-8", "replace"))
                if start is not None:
                    said = unescape(text[start:stop])
                    state[2] += len(said)
                    state[3].update(said.encode("utf-8", "replace"))
                state[4] += len(text)
            yield rows(out)
        if now:
            yield rows([done()])

    def rows(out):
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        ids, *columns = zip(*out) if out else ((),) * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, key_type), *[pa.array(c, t) for c, t in zip(columns, kinds)]], [key, *FIGURES]
        )

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(formatted.schema[key].dataType)
    kind = formatted.schema[key].dataType.simpleString()
    return (
        formatted.repartition(key).sortWithinPartitions(key, "place")
        .mapInArrow(run, f"{key} {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    )
