"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all preceding turns as context, then that reply, which
alone is trainable (``loss_start, loss_end`` in code points of the example's text).  Turns after
the last reply, or all turns of a conversation without one, come as one example without a
target, so the output holds every turn.

Template: ``[INST]role\\ntext[/INST]``; for the assistant ``<s>role\\ntext</s>``.  Control strings
inside roles and texts are broken by a backslash after their first character, backslashes are
doubled, and line ends in roles are written ``\\n``: reading back undoes it exactly.

Conversations are sorted streams (partitioned by id, sorted by turn, role, text), handled turn by
turn.  The context of T replies is repeated T times by definition of the expansion.  Defined
cases: null text or role counts as empty, null turns sort first, equal turns keep both rows in
role, text order, rows with a null conversation id form one conversation, an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import ship

ASSISTANT = "assistant"
CONTROL = re.compile(r"([\[<])(?=/?INST\]|/?s>)")


def escape(text: str) -> str:
    return CONTROL.sub(r"\1" + r"\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """Opening mark with role, escaped text, closing mark."""
    left, right = ("<s>", "</s>") if role == ASSISTANT else ("[INST]", "[/INST]")
    head = escape(role).replace("\n", "\\n") if "\n" in role else escape(role)
    return f"{left}{head}\n", escape(text), right


def read_turns(text: str) -> list[tuple[str, str]]:
    """``(role, text)`` of a formatted text."""
    out, at = [], 0
    while at < len(text):
        left, right = ("<s>", "</s>") if text.startswith("<s>", at) else ("[INST]", "[/INST]")
        if not text.startswith(left, at):
            raise ValueError(f"no turn mark at {at}")
        end = text.index(right, at)
        role, body = text[at + len(left):end].split("\n", 1)
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)
        out.append((role, unescape(body)))
        at = end + len(right)
    return out


def format_chats(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, example, n_turns, text, loss_start, loss_end)``, examples of a conversation in order.

    ``loss_start`` and ``loss_end`` are null for the example without a target.  Rows stay
    partitioned by conversation and in order, so a narrow step can read them on.
    """
    ship(conversations.sparkSession)
    c = conversations
    src = c.select(c[f"`{conv_col}`"].cast("long").alias("conv_id"), c[f"`{turn_col}`"].cast("long").alias("turn"),
                   F.coalesce(c[f"`{role_col}`"].cast("string"), F.lit("")).alias("role"),
                   F.coalesce(c[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))
    src = src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        import pyarrow as pa

        names = ["conv_id", "example", "n_turns", "text", "loss_start", "loss_end"]
        rows, size = [], 0
        conv, text, turns, number, closed = (), [], 0, 0, True
        length = 0

        def rest():
            return [] if closed else [(conv, number, turns, "".join(text), None, None)]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(
                zip(*rows), [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()])], names)

        for b in batches:
            for i, role, body in zip(*(b.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if i != conv:
                    rows += rest()
                    conv, text, turns, number, closed, length = i, [], 0, 0, True, 0
                left, mid, right = turn_parts(role, body)
                start = length + len(left)
                text += [left, mid, right]
                length = start + len(mid) + len(right)
                turns, closed = turns + 1, role == ASSISTANT
                if closed:
                    whole = "".join(text)
                    text = [whole]
                    rows.append((i, number, turns, whole, start, start + len(mid)))
                    number += 1
                    size += length
                if size > 4 << 20:
                    yield batch(rows)
                    rows, size = [], 0
        rows += rest()
        if rows:
            yield batch(rows)

    return src.select("conv_id", "role", "text").mapInArrow(
        run, "conv_id long, example long, n_turns long, text string, loss_start long, loss_end long")


def read_back(examples: DataFrame) -> DataFrame:
    """Digests per conversation, read from the formatted examples alone (in their order)."""

    def run(batches):
        import pyarrow as pa

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        held = None  # conv, loss digest, loss chars, formatted chars, last text
        rows = []

        def close():
            turns = read_turns(held[4])
            sha = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass"))
            rows.append((held[0], len(turns), sha.hexdigest(), held[2], held[1].hexdigest(), held[3]))

        def batch(rows):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names)

        for b in batches:
            for i, text, s, e in zip(*(b.column(n).to_pylist() for n in ("conv_id", "text", "loss_start", "loss_end"))):
                if held is None or held[0] != i:
                    if held is not None:
                        close()
                    held = [i, hashlib.sha256(), 0, 0, ""]
                if s is not None:
                    reply = unescape(text[s:e])
                    held[1].update(reply.encode("utf-8", "surrogatepass"))
                    held[2] += len(reply)
                held[3] += len(text)
                held[4] = text
            if rows:
                yield batch(rows)
                rows.clear()
        if held is not None:
            close()
            yield batch(rows)

    return examples.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                    "loss_sha256 string, formatted_chars long")
