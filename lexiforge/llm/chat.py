r"""Chat formatting with a grammar round trip.

Template (a turn): ``### `` role ``: `` text ``</turn>`` and a line end. Inside roles and
texts every control string (``###``, ``</turn>``, ``: ``) gets a backslash in front. The
rendered text of each turn is read back by a deterministic parser and compared with its
source; where they differ, as backslashes before a control string make them, the turn is
rendered again with every backslash escaped too, which always reads back. The parser
needs no level: an escape is a backslash before a control string or a backslash.

Turns are rendered in parallel before the shuffle, each with its loss mask: the span of the
rendered text, in characters, on which a model is trained (the text of an assistant's turn).
``formatted_texts`` gives whole conversations with their masks. For digests a
conversation's turns are streamed in order through one state, in one task, so memory does
not grow with its length.

Defined cases: null text is empty, a null role is the empty role; turns of equal number
are ordered by role and text, null turns come first; a null conv_id is one conversation;
repeated rows are repeated turns; long texts are escaped and read whole; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The control strings of the template.
OPEN, MID, CLOSE = "### ", ": ", "</turn>\n"
CONTROLS = ("###", "</turn>", ": ")
_ANY = "|".join(re.escape(x) for x in CONTROLS)
_EVERY = re.compile(rf"\\|{_ANY}", re.S)
_ESCAPED = re.compile(rf"\\(\\|{_ANY})", re.S)


def escape(text: str, level: int = 1) -> str:
    if level == 0:
        return re.sub(rf"{_ANY}", lambda m: "\\" + m[0], text)
    return _EVERY.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render_turn(role: str, text: str, level: int) -> str:
    return f"{OPEN}{escape(role, level)}{MID}{escape(text, level)}{CLOSE}"


class ParseError(ValueError):
    pass


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start and end of the text's span) for each turn; the whole string must be turns."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(OPEN, at):
            raise ParseError(f"no turn opens at {at}")
        role_end = _control(rendered, at + len(OPEN), MID)
        text_at = role_end + len(MID)
        text_end = _control(rendered, text_at, CLOSE)
        turns.append((unescape(rendered[at + len(OPEN) : role_end]), unescape(rendered[text_at:text_end]), text_at, text_end))
        at = text_end + len(CLOSE)
    return turns


_SCAN = re.compile(rf"\\(?:\\|{_ANY})|{_ANY}", re.S)


def _control(rendered: str, at: int, wanted: str) -> int:
    """Where the first unescaped control string stands; it has to be ``wanted``."""
    for m in _SCAN.finditer(rendered, at):
        if m[0][0] != "\\":
            if rendered.startswith(wanted, m.start()):
                return m.start()
            raise ParseError(f"{m[0]!r} at {m.start()}")
    raise ParseError("unclosed turn")


def round_trip(role: str, text: str) -> str:
    """One rendered turn that reads back as (role, text), at the mildest level that does."""
    for level in (0, 1):
        out = render_turn(role, text, level)
        try:
            back = parse(out)
        except ParseError:
            continue
        if len(back) == 1 and back[0][:2] == (role, text):
            return out
    raise ParseError("no level reads back")  # level 1 always does


LOSS_ROLES = ("assistant",)


def rendered_turns(turns: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """Rows (conv_id, turn, role, text) with ``formatted``, each read back and compared, and its loss span.

    ``loss_start`` and ``loss_end`` are character offsets in ``formatted``; null where no loss is taken.
    """
    kind = pa.struct([("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])

    @F.arrow_udf("struct<formatted: string, loss_start: long, loss_end: long>")
    def fmt(role: pa.Array, text: pa.Array) -> pa.Array:
        out = []
        for r, t in zip(role.to_pylist(), text.to_pylist(), strict=True):
            made = round_trip(r or "", t or "")
            (_, _, start, end) = parse(made)[0]
            taken = r in loss_roles
            out.append({"formatted": made, "loss_start": start if taken else None, "loss_end": end if taken else None})
        return pa.array(out, kind)

    return turns.withColumn("__lf_f", fmt(F.col("role"), F.col("text"))).select(*turns.columns, "__lf_f.*")


def _in_order(rows: DataFrame, *columns: str) -> DataFrame:
    """A conversation's turns, one after the other, in one task."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select(*columns)


def formatted_texts(turns: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """(conv_id, formatted, loss): each whole conversation and the spans (start, end) of its loss mask."""
    narrow = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    dealt = _in_order(rendered_turns(narrow, loss_roles), "conv_id", "formatted", "loss_start", "loss_end")
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(span))])

    def whole(batches):
        held: dict | None = None

        def done(x):
            return {"conv_id": x["conv_id"], "formatted": "".join(x["parts"]), "loss": x["loss"]}

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if held is None or held["conv_id"] != r["conv_id"]:
                    if held is not None:
                        out.append(done(held))
                    held = {"conv_id": r["conv_id"], "parts": [], "loss": [], "at": 0}
                if r["loss_start"] is not None:
                    held["loss"].append({"start": held["at"] + r["loss_start"], "end": held["at"] + r["loss_end"]})
                held["parts"].append(r["formatted"])
                held["at"] += len(r["formatted"])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([done(held)], schema)

    return dealt.mapInArrow(whole, "conv_id long, formatted string, loss array<struct<start: long, end: long>>")


def conversation_digests(rows: DataFrame) -> DataFrame:
    """One row a conversation, from what the parser and the loss mask read in the rendered turns."""
    dealt = _in_order(rows, "conv_id", "formatted", "loss_start", "loss_end")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def digest(batches):
        from hashlib import sha256

        def done(s):
            return [s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]]

        state = None
        for batch in batches:
            out = []
            for conv, formatted, loss_start, loss_end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or state[0] != conv:
                    if state is not None:
                        out.append(done(state))
                    state = [conv, 0, sha256(), 0, sha256(), 0]
                for role, text, _, _ in parse(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                if loss_start is not None:
                    taught = unescape(formatted[loss_start:loss_end])
                    state[3] += len(taught)
                    state[4].update(taught.encode())
                state[5] += len(formatted)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(done(state), kinds, strict=True)], names)

    return dealt.mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def format_conversations(turns: DataFrame) -> DataFrame:
    """Digests of all conversations of ``turns(conv_id, turn, role, text)``."""
    narrow = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return conversation_digests(rendered_turns(narrow))
