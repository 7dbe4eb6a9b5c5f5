"""Event-sourced chat formatting (operator 4).

Input is a log of events ``conv_id, seq, kind, message, role, text``:

* ``message`` opens a message (its role, and perhaps first text);
* ``delta`` appends streamed text to a message;
* ``edit`` replaces the text that the message has so far;
* ``regenerate`` discards that text, so that later deltas build it anew, and
  withdraws every message of the conversation that was opened after this
  one and before this event.

``messages`` spreads the log by conversation and message, sorts each
message's events by sequence and folds them, one message in memory at a
time; a conversation that holds a third of the log is many groups there.
``formatted`` then sorts the folded messages of a conversation by their
opening event and renders them in one streaming pass, again one message at a
time: one output row per message, with its place in the conversation's text
and the span under the loss mask (assistant text).

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and texts a
backslash becomes two and ``<|`` becomes ``<\\|`` (in roles also a line feed
``\\n``), so no control string can stand there and ``unescaped`` restores
them.

Events with equal ``seq`` apply in the order message, edit, regenerate,
delta, then by text; an event repeated in all columns (a log delivered
twice) applies once.  Null texts and roles count as empty, a message's role
is the last one given; null ``conv_id``, ``message`` and ``seq`` are values
like any other and sort first; unknown kinds are ignored; other columns are
ignored; an empty log gives no rows.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lampwatch.llm.common import n_tasks

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
KINDS = ("message", "edit", "regenerate", "delta")
MESSAGES = "conv_id long, message long, opened long, regenerated long, role string, text string"
PIECES = ("conv_id long, turn long, role string, piece string, start long, "
          "loss_start long, loss_end long")


def escaped(text: str, name: bool = False) -> str:
    text = text.replace("\\", "\\\\").replace("<|", "<\\|")
    return text.replace("\n", "\\n") if name else text


def unescaped(text: str, name: bool = False) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if name and m[1] == "n" else m[1], text, flags=re.S)


def parsed(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted text."""
    out, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn begins at character {at}")
        line = formatted.index("\n", at)
        end = formatted.index(END, line)
        out.append((unescaped(formatted[at + len(START):line], True),
                    unescaped(formatted[line + 1:end])))
        at = end + len(END) + 1
    return out


def messages(log: DataFrame) -> DataFrame:
    """Fold the events of each message: ``MESSAGES`` rows, ``regenerated``
    being the last sequence number that regenerated it."""
    def fold(batches):
        import pyarrow as pa

        key, state, last, out = None, None, None, []

        def closed():
            return (*key, state["opened"], state["regenerated"], state["role"],
                    "".join(state["text"]))

        def rows(out):
            cols = list(zip(*out)) or [()] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.string()] * 2)],
                names=["conv_id", "message", "opened", "regenerated", "role", "text"])

        for b in batches:
            for event in zip(*(c.to_pylist() for c in b.columns)):
                conv, message, seq, order, role, text = event
                if (conv, message) != key:
                    if state:
                        out.append(closed())
                    key, last = (conv, message), None
                    state = {"opened": seq, "regenerated": None, "role": "", "text": []}
                if event == last:
                    continue  # delivered twice
                last = event
                if role is not None:
                    state["role"] = role
                if order in (1, 2):
                    state["text"] = []
                if order == 2:
                    state["regenerated"] = seq
                if text:
                    state["text"].append(text)
            if out:
                yield rows(out)
                out = []
        if state:
            yield rows([closed()])

    order = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS)])
    events = (log.select(F.col("conv_id").cast("long"), F.col("message").cast("long"),
                         F.col("seq").cast("long"), order.cast("int").alias("kind"),
                         F.col("role").cast("string"), F.col("text").cast("string"))
              .where("kind is not null"))
    return (events.repartition(n_tasks(log), "conv_id", "message")
            .sortWithinPartitions("conv_id", "message", "seq", "kind", "text", "role")
            .mapInArrow(fold, MESSAGES))


def formatted(log: DataFrame) -> DataFrame:
    """``PIECES`` rows, one per message that stands, in conversation order
    within a partition: its rendered text, the code points of the
    conversation before it, and the span of the conversation's text that is
    learned (null for roles that are not)."""
    def render(batches):
        import pyarrow as pa

        from lampwatch.llm.chatlog import END, LEARNED_ROLE, START, escaped
        conv, turn, at, withdrawn = object(), 0, 0, None
        for b in batches:
            out = []
            for c, _, opened, regenerated, role, text in zip(*(x.to_pylist() for x in b.columns)):
                if c != conv:
                    conv, turn, at, withdrawn = c, 0, 0, None
                gone = withdrawn is not None and (opened is None or opened < withdrawn)
                if regenerated is not None and not gone:
                    withdrawn = max(regenerated, withdrawn if withdrawn is not None else regenerated)
                if gone:
                    continue
                head = f"{START}{escaped(role, True)}\n"
                body = escaped(text)
                piece = f"{head}{body}{END}\n"
                learned = role == LEARNED_ROLE
                out.append((c, turn, role, piece, at, at + len(head) if learned else None,
                            at + len(head) + len(body) if learned else None))
                turn, at = turn + 1, at + len(piece)
            cols = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(cols, [pa.int64(), pa.int64(), pa.string(), pa.string(),
                                                       pa.int64(), pa.int64(), pa.int64()])],
                names=["conv_id", "turn", "role", "piece", "start", "loss_start", "loss_end"])

    return (messages(log).repartition(n_tasks(log), "conv_id")
            .sortWithinPartitions("conv_id", "opened", "message")
            .mapInArrow(render, PIECES))


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its rendered text and loss
    spans in one streaming pass over ``formatted``'s partitions: ``conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    def digest(batches):
        import pyarrow as pa

        from lampwatch.llm.chatlog import parsed, unescaped
        conv, state = None, None

        def row(conv, s):
            return (conv, s["n"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"])

        def rows(out):
            cols = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                       "formatted_chars"])

        for b in batches:
            out = []
            for c, _, _, piece, start, lo, hi in zip(*(x.to_pylist() for x in b.columns)):
                if state is None or c != conv:
                    if state:
                        out.append(row(conv, state))
                    conv = c
                    state = {"n": 0, "chars": 0, "loss_chars": 0, "turns": hashlib.sha256(),
                             "loss": hashlib.sha256()}
                for role, text in parsed(piece):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                state["chars"] += len(piece)
                if lo is not None:
                    learned = unescaped(piece[lo - start:hi - start])
                    state["loss_chars"] += len(learned)
                    state["loss"].update(learned.encode("utf-8", "surrogatepass"))
            if out:
                yield rows(out)
        if state:
            yield rows([row(conv, state)])

    return pieces.mapInArrow(
        digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                "loss_sha256 string, formatted_chars long")


def as_log(rows: DataFrame, delta_chars: int = 512) -> DataFrame:
    """A table of finished turns (``conv_id, turn, role, text``) as the log
    that streaming them would have left: an opening event per turn and a
    delta per ``delta_chars`` code points.  Rows that share a turn follow in
    the order of role and text."""
    pos = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    turns = (rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                         F.col("role").cast("string"), F.col("text").cast("string"))
             .select("conv_id", "role", F.coalesce("text", F.lit("")).alias("text"),
                     pos.cast("long").alias("message")))

    def seq(step: Column) -> Column:
        return F.shiftleft(F.col("message"), 32) + step

    opened = F.array(F.struct(F.lit("message").alias("kind"), seq(F.lit(0)).alias("seq"),
                              F.coalesce("role", F.lit("")).alias("role"), F.lit("").alias("text")))
    # one pass over the text, whatever its length
    cut = F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0))
    deltas = F.transform(cut, lambda t, i: F.struct(F.lit("delta").alias("kind"), seq(i + 1).alias("seq"),
                                                    F.lit(None).cast("string").alias("role"), t.alias("text")))
    return turns.select("conv_id", "message", F.inline(F.concat(opened, deltas)))
