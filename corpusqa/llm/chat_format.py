"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
context, and only its reply is under the loss mask. Turns after the last reply
make a further example without a loss span, so that the output holds the whole
conversation.

Template: a turn is ``<|turn|>role`` newline ``text`` ``<|end|>`` newline. In
texts and roles a backslash is put before the second character of a control
string and before every backslash, in roles also before a newline; taking one
backslash away from each escape gives the text back.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>\n"
REPLY = "assistant"
# Control strings of common chat templates: "<|...", "<s>", "</s>", "[INST]",
# "[/INST]", "<<SYS>>", "<</SYS>>". What stands before the lookahead is kept.
_CONTROL = re.compile(r"\\|<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])")
_ROLE = re.compile(r"((?:[^\\\n]|\\.)*)\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_OUT = 1 << 24  # characters of examples in one Arrow batch, about


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn_parts(role: str | None, text: str | None) -> tuple[str, str, str]:
    """What stands before a turn's text, the escaped text, and what stands after it."""
    return TURN + escape(role or "").replace("\n", "\\\n") + "\n", escape(text or ""), END


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted example."""
    turns = []
    for own in formatted.split(TURN)[1:]:
        head = _ROLE.match(own)
        turns.append((unescape(head[1]), unescape(own[head.end() : -len(END)])))
    return turns


def expand(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per example: conv_id, example (from 0), n_context (turns before
    the target), formatted, loss_start and loss_end (code points of the reply in
    ``formatted``; null in an example without a reply).

    Turns stand in the order of ``turn``; ties, and null turns (first), by role
    and text. Null roles and texts are empty; rows that repeat are turns of
    their own; a null conv_id is a conversation. Rows are streamed in order: a
    task holds the formatted text of the conversation at hand, not its rows.
    Other columns are not read; an empty table gives an empty result.
    """
    rows = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text")
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        import pyarrow as pa

        names = ["conv_id", "example", "n_context", "formatted", "loss_start", "loss_end"]
        kinds = [None, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        out: list[list] = [[] for _ in names]
        size = 0

        def add(*row):
            nonlocal size
            for column, value in zip(out, row):
                column.append(value)
            size += len(row[3])

        def flush():
            nonlocal out, size
            batch = pa.RecordBatch.from_arrays([pa.array(c, kinds[0] if i == 0 else k) for i, (c, k) in enumerate(zip(out, kinds))], names=names)
            out, size = [[] for _ in names], 0
            return batch

        now, context, seen, example, open_ = object(), "", 0, 0, False
        for batch in batches:
            kinds[0] = batch.schema.field(0).type
            for conv, who, what in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if conv != now:
                    if open_:
                        add(now, example, seen, context, None, None)
                    now, context, seen, example, open_ = conv, "", 0, 0, False
                before, body, after = turn_parts(who, what)
                start = len(context) + len(before)
                context += before + body + after
                open_ = who != REPLY
                if not open_:
                    add(conv, example, seen, context, start, start + len(body))
                    example += 1
                seen += 1
                if size >= _OUT:
                    yield flush()
        if open_:
            add(now, example, seen, context, None, None)
        if out[0]:
            yield flush()

    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {kind}, example long, n_context long, formatted string, loss_start long, loss_end long")


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, read from the formatted examples alone: n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            col = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names) if n != "conv_id"}
            turns, digests, losses = [], [], []
            for formatted, a, b in zip(col["formatted"], col["loss_start"], col["loss_end"]):
                own = parse(formatted)
                turns.append(len(own))
                digests.append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest())
                losses.append("" if a is None else unescape(formatted[a:b]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(col["example"], pa.int64()), pa.array(turns, pa.int64()), pa.array(digests, pa.string()), pa.array(losses, pa.string()),
                 pa.array([len(f) for f in col["formatted"]], pa.int64())],
                names=["conv_id", "example", "n_turns", "turns_sha256", "loss", "chars"],
            )

    kind = examples.schema["conv_id"].dataType.simpleString()
    rows = examples.select("conv_id", "example", "formatted", "loss_start", "loss_end")
    rows = rows.mapInArrow(run, f"conv_id {kind}, example long, n_turns long, turns_sha256 string, loss string, chars long")
    last = F.max(F.struct("example", "n_turns", "turns_sha256"))
    loss = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "")
    whole = rows.groupBy("conv_id").agg(last.alias("last"), loss.alias("loss"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_examples"))
    return whole.select(
        "conv_id", "last.n_turns", "last.turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_examples"
    )
