"""Chat formatting by prefix-target expansion.

Every assistant turn becomes its own example: all turns before it are context and
only its text is trainable (one span of code points under the loss mask).  Turns
after the last assistant turn, or a conversation without one, come as one last
example without a target, so that the output holds every turn.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.  Control strings inside
texts are escaped reversibly: ``<`` + n backslashes + ``|`` gets one backslash more
(so no ``<|`` is left), in roles also backslashes and line ends.

Edge cases: null text or role counts as empty; turns are ordered by (turn, role,
text), so ties and repeated rows have one defined order and repeated rows are
turns of their own; rows with a null conv_id form a conversation; other columns
are ignored; an empty table gives no examples.  A conversation of any length is worked off
example by example, in batches of bounded size: its examples are long by definition
(all turns before each reply), but are never all held.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed

START, END = "<|im_start|>", "<|im_end|>"
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_ROLE = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turns(turns: list[tuple[str, str]]):
    """The examples of one conversation, one at a time: (text, trainable spans, turns
    held).  Together they are as long as the conversation times its replies."""
    text, done = "", 0
    for i, (role, body) in enumerate(turns, 1):
        text += f"{START}{escape_role(role)}\n"
        at = len(text)
        text += escape(body)
        span = (at, len(text))
        text += f"{END}\n"
        if role == "assistant":
            yield text, [span], i
            done = i
    if done < len(turns):
        yield text, [], len(turns)


def parse(text: str) -> list[tuple[str, str]]:
    """Read the turns back from a formatted text."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(text)]


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
EXAMPLE = "conv_id {id}, example int, n_examples int, n_turns int, text string, loss array<struct<start:long,end:long>>"


#: Characters of examples that are handed on at once (a longer example alone).
BATCH_CHARS = 8 << 20


def _expand(batches):
    for batch in batches:
        kinds = [batch.schema.field("conv_id").type, pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(SPAN)]
        names = ["conv_id", "example", "n_examples", "n_turns", "text", "loss"]

        def made(rows, kinds=kinds, names=names):
            cols = list(zip(*rows)) if rows else [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
        rows, held = [], 0
        for conv, said in zip(batch.column("conv_id"), batch.column("turns")):
            turns = [(t["role"], t["text"]) for t in said.as_py()]
            n = sum(role == "assistant" for role, _ in turns) + (bool(turns) and turns[-1][0] != "assistant")
            for k, (text, loss, held_turns) in enumerate(format_turns(turns)):
                if rows and held + len(text) > BATCH_CHARS:
                    yield made(rows)
                    rows, held = [], 0
                rows.append((conv.as_py(), k, n, held_turns, text, [{"start": a, "end": b} for a, b in loss]))
                held += len(text)
        yield made(rows)


def expand(turns: DataFrame) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` -> one row per example: ``conv_id, example,
    n_examples, n_turns, text, loss`` (spans of code points).  A group is one
    conversation, which an example holds whole by definition."""
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    whole = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    kind = turns.schema["conv_id"].dataType.simpleString()
    return packed(whole).mapInArrow(_expand, EXAMPLE.format(id=kind))


READ = "conv_id {id}, example int, n_turns long, transcript string, loss_text string, chars long"


def _read(batches):
    for batch in batches:
        n, transcript, loss, chars = [], [], [], []
        for k, last, text, spans in zip(*(batch.column(c) for c in ("example", "n_examples", "text", "loss"))):
            k, last, text, spans = k.as_py(), last.as_py(), text.as_py(), spans.as_py()
            turns = parse(text) if k == last - 1 else None      # the last example holds every turn
            n.append(None if turns is None else len(turns))
            transcript.append(None if turns is None else "".join(f"{r}\n{t}\n" for r, t in turns))
            loss.append("".join(unescape(text[s["start"]:s["end"]]) for s in spans))
            chars.append(len(text))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("example"), pa.array(n, pa.int64()),
             pa.array(transcript, pa.string()), pa.array(loss, pa.string()), pa.array(chars, pa.int64())],
            ["conv_id", "example", "n_turns", "transcript", "loss_text", "chars"])


def read_back(examples: DataFrame) -> DataFrame:
    """What the examples hold, per conversation: ``conv_id, n_turns, transcript,
    loss_text, formatted_chars, n_examples``."""
    kind = examples.schema["conv_id"].dataType.simpleString()
    parts = packed(examples).mapInArrow(_read, READ.format(id=kind))
    in_order = F.sort_array(F.collect_list(F.struct("example", "loss_text")))
    return parts.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max("transcript").alias("transcript"),
        F.array_join(F.transform(in_order, lambda x: x["loss_text"]), "").alias("loss_text"),
        F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_examples"))
