"""Roles of transcript lines by a hidden Markov model, and canonical rendering of the turns.

The states are the roles; a line shows a speaker marker (a role name, one of its usual synonyms, or none), its length, how it
ends, and its first sign. Start, transition and emission probabilities are counted on the lines whose marker is known.
Viterbi decoding gives each line its role: a marker fixes it, and lines without one take the role that fits their
neighbours and their looks. Rows that are turns stay separate turns (``recover``). In a transcript (``recover_lines``) a line
without a marker goes on with the turn before it or, rarely, opens a turn whose marker is missing.

A conversation is decoded in blocks of ``BLOCK`` turn numbers. Each block is decoded for every role before it and every last
role, so blocks are independent; the best chain of blocks needs nine numbers per block. So no task holds
a whole conversation of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covercast.llm.storage import importable, written

ROLES = ("system", "user", "assistant")
K = len(ROLES)
# Usual names of the speakers.
SYNONYMS = {
    "system": "system developer instruction instructions context",
    "user": "user human customer question prompter client you",
    "assistant": "assistant ai bot gpt model agent answer response chatbot",
}
MARKER = r"(?i)^[\s#*>\[<|]*(?:im_start\|>)?\s*([a-z]+)\s*[\]*|>]*\s*(?::|\|>|\]|\n)\s*"
BLOCK = 256
#: Weight of the counts of a smoothed probability, and the share of turns in a transcript whose marker may be missing.
SMOOTH, MISSING = 1.0, 0.02
#: Ends of lines as ``^`` sees them.
LINE_ENDS = r"(?<=[\n\u0085\u2028\u2029]|\r(?!\n))"
#: Feature values: marker (none or a role), length, ending, first sign.
LENGTHS, ENDINGS, SIGNS = 8, 4, 4
FEATURES = (LENGTHS, ENDINGS, SIGNS)


def role_of(name: Column) -> Column:
    """Number of the role that a name stands for; null where it stands for none."""
    low = F.lower(F.trim(name))
    found = F.lit(None).cast("int")
    for i, role in enumerate(ROLES):
        found = F.when(low.isin(SYNONYMS[role].split()), F.lit(i)).otherwise(found)
    return found


def marked_lines(transcripts: DataFrame, key: str = "conv_id", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) from whole transcripts: a turn starts at each line with a speaker marker.

    Lines before the first marker form a turn without a role; marker names that are no speaker's are text.
    """
    names = "|".join(sorted(n for s in SYNONYMS.values() for n in s.split()))
    starts = rf"(?im)^(?=[\s#*>\[<|]*(?:im_start\|>)?\s*(?:{names})\s*[\]*|>]*\s*(?::|\|>|\]))"
    parts = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), starts), lambda p: F.length(F.trim(p)) > 0)
    turns = transcripts.select(F.col(key).alias("conv_id"), F.posexplode(parts).alias("turn", "text"))
    name = F.regexp_extract("text", MARKER, 1)
    known = role_of(name).isNotNull()
    return turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(known, name).alias("role"),
        F.btrim(F.when(known, F.regexp_replace("text", MARKER, "")).otherwise(F.col("text")), F.lit(" \t\r\n")).alias("text"),
    )


def _like_marker() -> str:
    """Pattern of the start of a line that a parser could take for a marker or a part of one."""
    names = "|".join(sorted(n for s in SYNONYMS.values() for n in s.split()))
    return rf"[\s#*>\[<|]*(?:im_start\|>)?\s*(?:(?:{names})\b|$)"


def transcripts(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(place, text): the transcript of each conversation, a row per block of ``BLOCK`` turn numbers.

    A turn is written as ``role: text`` and ends its line; without a known role it is its text alone. Lines of a text that look
    like markers get a backslash. Order and nulls as in ``recover``.
    """
    clean = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.transform(
        F.split(clean, LINE_ENDS, -1), lambda x: F.when(x.rlike(rf"(?i)^\\*{_like_marker()}"), F.concat(F.lit("\\"), x)).otherwise(x)
    )
    known = role_of(F.col(role).cast("string"))
    name = F.element_at(F.array(*[F.lit(r) for r in ROLES]), known + 1)
    marker = F.when(known.isNotNull(), F.concat(name, F.lit(": "))).otherwise(F.lit(""))
    said = F.concat(marker, F.array_join(lines, ""), F.lit("\n"))
    number = F.col(turn).cast("bigint")
    place = F.struct(
        F.col(key).cast("bigint").alias("conv_id"), F.floor(F.coalesce(number, F.lit(0)) / BLOCK).cast("bigint").alias("block")
    )
    row = F.struct(number.alias("turn"), known.alias("marker"), said.alias("said"))
    rows = turns.select(place.alias("place"), row.alias("row")).groupBy("place").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return rows.select("place", F.array_join("rows.said", "").alias("text"))


def observed_lines(transcripts: DataFrame) -> DataFrame:
    """The lines of transcripts (place, text), shaped as by ``observed``; ``turn`` numbers the lines of a block in order."""
    parts = marked_lines(transcripts, "place").select(
        F.col("conv_id").alias("place"), "turn", role_of(F.col("role")).alias("marker"), F.posexplode(F.split("text", LINE_ENDS, -1)).alias("at", "line")
    )
    line = F.when(F.col("line").rlike(rf"(?i)^\\+{_like_marker()}"), F.substring("line", 2, 2**31 - 1)).otherwise(F.col("line"))
    length, ending, sign = looks(F.btrim(line, F.lit(" \t\r\n")))
    return parts.select(
        F.col("place.conv_id").alias("conv_id"),
        F.col("place.block").alias("block"),
        (F.shiftleft("turn", 32) + F.col("at")).alias("turn"),
        F.when(F.col("at") == 0, F.col("marker")).alias("marker"),
        length.alias("f0"),
        ending.alias("f1"),
        sign.alias("f2"),
        line.alias("text"),
    )


def looks(text: Column) -> list[Column]:
    """Length on a doubling scale, how the text ends, and its first sign, as small numbers."""
    size = F.length(text)
    length = F.least(F.lit(LENGTHS - 1), F.greatest(F.lit(0), F.floor(F.log2(size + 1.0)) - 2)).cast("int")
    last, first = F.substring(text, -1, 1), F.substring(F.ltrim(text), 1, 1)
    ending = F.when(size == 0, 0).when(last == "?", 1).when(last.isin(".", "!", "…"), 2).otherwise(3)
    sign = F.when(first.rlike(r"[-*•`#|>]"), 1).when(first.rlike(r"\d"), 2).when(first.rlike(r"\p{Lu}"), 3).otherwise(0)
    return [length, ending, sign]


def observed(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    clean = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(key).cast("bigint").alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        role_of(F.col(role).cast("string")).alias("marker"),
        clean.alias("text"),
    )
    length, ending, sign = looks(F.col("text"))
    block = F.floor(F.coalesce("turn", F.lit(0)) / BLOCK).cast("bigint")
    return rows.select("conv_id", block.alias("block"), "turn", "marker", length.alias("f0"), ending.alias("f1"), sign.alias("f2"), "text")


def in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of a block together, in order of turn (null first), then marker and text."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "block", "turn", "marker")]
    return rows.repartition("conv_id", "block").sortWithinPartitions(*order, "text")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Blocks over batches: (conv_id, block, marker or -1, features) as one array per batch, whole blocks only."""
    rest = None
    for batch in batches:
        columns = [batch.column(i).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)]
        null_id = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        rows = np.stack([columns[0], columns[1], null_id.astype(np.int64), *columns[2:]], axis=1)
        if rest is not None:
            rows = np.concatenate([rest, rows])
        change = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        starts = np.concatenate([[0], change])
        for a, b in zip(starts[:-1], starts[1:]):
            yield rows[a:b]
        rest = rows[starts[-1] :]
    if rest is not None and len(rest):
        yield rest


def _count_partition(batches: Iterator[pa.RecordBatch], lines: bool) -> Iterator[pa.RecordBatch]:
    """Counts (kind, a, b): -1 start, -2 transition, -3 lines that open (0) or go on with (1) a turn, else emission of feature
    ``kind``; over rows with a marker, and lines that follow one."""
    counts: dict[tuple[int, int, int], int] = {}

    def add(kind: int, a: np.ndarray, b: np.ndarray) -> None:
        for (x, y), n in zip(*np.unique(np.stack([a, b], axis=1), axis=0, return_counts=True)):
            counts[kind, int(x), int(y)] = counts.get((kind, int(x), int(y)), 0) + int(n)

    for run in _runs(batches):
        m = run[:, 3]
        known = m >= 0
        if known[0] and run[0, 1] <= 0:
            add(-1, np.zeros(1, np.int64), m[:1])
        if lines:
            opened, spoken = known, m[known]
            last = np.maximum.accumulate(np.where(known, np.arange(len(m)), -1))
            m = np.where(last >= 0, m[last], -1)
            known = m >= 0
            if known.any():
                add(-3, m[known], (~opened[known]).astype(np.int64))
            if len(spoken) > 1:
                add(-2, spoken[:-1], spoken[1:])
        else:
            both = known[1:] & known[:-1]
            if both.any():
                add(-2, m[:-1][both], m[1:][both])
        for f in range(len(FEATURES)):
            if known.any():
                add(f, m[known], run[known, 4 + f])
    if counts:
        kinds, a, b = zip(*counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int32()) for x in (kinds, a, b)] + [pa.array(list(counts.values()), pa.int64())],
            ["kind", "a", "b", "n"],
        )


class Model:
    """Log-probabilities of starts, transitions, markers and looks, from smoothed counts.

    ``move`` leads to a row that is a turn, or to a marked line; ``go_on`` to a line without a marker.
    """

    def __init__(self, counts: list[tuple[int, int, int, int]], lines: bool = False):
        start, move, length = np.full(K, SMOOTH), np.full((K, K), SMOOTH), np.full((K, 2), SMOOTH)
        shows = [np.full((K, size), SMOOTH) for size in FEATURES]
        for kind, a, b, n in counts:
            table = start[None] if kind == -1 else move if kind == -2 else length if kind == -3 else shows[kind]
            table[a, b] += n
        self.start = np.log(start / start.sum())
        move = move / move.sum(axis=1, keepdims=True)
        ends, stays = (length / length.sum(axis=1, keepdims=True)).T[:, :, None]
        self.move = np.log(ends * (1 - MISSING) * move if lines else move)
        self.go_on = np.log(ends * MISSING * move + stays * np.eye(K)) if lines else self.move
        self.shows = [np.log(t / t.sum(axis=1, keepdims=True)) for t in shows]
        marker = np.full((K, K + 1), -np.inf)
        marker[np.arange(K), np.arange(K)] = 0.0
        marker[:, K] = 0.0
        self.marker = marker

    def emissions(self, run: np.ndarray) -> np.ndarray:
        """(rows, roles): the log-probability of what each row shows."""
        out = self.marker[:, np.where(run[:, 3] < 0, K, run[:, 3])].T.copy()
        for f, table in enumerate(self.shows):
            out += table[:, run[:, 4 + f]].T
        return out


def decode(model: Model, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Viterbi over one block for every role before it (the last choice: none, it is the first) and every last role.

    Returns the best log-probabilities (K + 1, K) and the roles (rows, K + 1, K). Ties go to the earlier role.
    """
    shown, unmarked = model.emissions(run), run[:, 3] < 0
    entries = np.concatenate([model.move, model.start[None]])
    best = entries + shown[0]
    back = np.empty((len(run), K + 1, K), np.int8)
    for t in range(1, len(run)):
        options = best[:, :, None] + (model.go_on if unmarked[t] else model.move)[None]
        back[t] = options.argmax(axis=1)
        best = options.max(axis=1) + shown[t]
    roles = np.empty((len(run), K + 1, K), np.int8)
    at = np.broadcast_to(np.arange(K), (K + 1, K)).copy()
    for t in range(len(run) - 1, -1, -1):
        roles[t] = at
        if t:
            at = np.take_along_axis(back[t], at, axis=1)
    return best, roles


def _decode_partition(batches: Iterator[pa.RecordBatch], counts: list, lines: bool) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, block, marker, f0, f1, f2, turn, text) with every choice of roles, and the block's scores."""
    model = Model(counts, lines)
    held: list[pa.RecordBatch] = []

    def feed() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held.append(batch)
            yield batch

    waiting = 0
    for run in _runs(feed()):
        best, roles = decode(model, run)
        scores = best.astype("<f8").tobytes()
        # The run's rows are the next ones of the held batches.
        done = 0
        while done < len(run):
            batch = held[0]
            some = batch.slice(waiting, min(batch.num_rows - waiting, len(run) - done))
            choices = [x.tobytes() for x in roles[done : done + some.num_rows].reshape(some.num_rows, -1)]
            yield pa.RecordBatch.from_arrays(
                [some.column(i) for i in (0, 1, 2, 6, 7)]
                + [pa.array(choices, pa.binary()), pa.array([scores] * some.num_rows, pa.binary())],
                ["conv_id", "block", "marker", "turn", "text", "choices", "scores"],
            )
            done += some.num_rows
            waiting += some.num_rows
            if waiting == batch.num_rows:
                held.pop(0)
                waiting = 0


def _chain_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv_id, block, scores) to (conv_id, block, choice): the best entry and last role of each block."""

    def chained(conv: int | None, blocks: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        best = blocks[0][1][K]
        back = [np.full(K, K)]
        for _, scores in blocks[1:]:
            options = best[:, None] + scores[:K]
            back.append(options.argmax(axis=0))
            best = options.max(axis=0)
        last = int(best.argmax())
        choices = []
        for b in back[::-1]:
            choices.append(int(b[last]) * K + last)
            last = int(b[last])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([conv] * len(blocks), pa.int64()),
                pa.array([b for b, _ in blocks], pa.int64()),
                pa.array(choices[::-1], pa.int32()),
            ],
            ["chain_conv", "chain_block", "choice"],
        )

    conv, blocks = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            mine, block = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            if blocks and mine != conv:
                yield chained(conv, blocks)
                blocks = []
            conv = mine
            blocks.append((block, np.frombuffer(batch.column(2)[i].as_py(), "<f8").reshape(K + 1, K)))
    if blocks:
        yield chained(conv, blocks)


def decoded(rows: DataFrame, lines: bool) -> DataFrame:
    """conv_id, block, turn, marker, role and text of every observed row."""
    rows = in_blocks(rows)
    seen = rows.select("conv_id", "block", "marker", "f0", "f1", "f2")
    counts = seen.mapInArrow(lambda it: _count_partition(it, lines), "kind int, a int, b int, n bigint")
    counts = counts.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).orderBy("kind", "a", "b").collect()
    counts = [tuple(r) for r in counts]
    choices = rows.select("conv_id", "block", "marker", "f0", "f1", "f2", "turn", "text").mapInArrow(
        lambda it: _decode_partition(it, counts, lines),
        "conv_id bigint, block bigint, marker int, turn bigint, text string, choices binary, scores binary",
    )
    choices = written(choices, "decoded")
    blocks = choices.groupBy("conv_id", "block").agg(F.min("scores").alias("scores"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("block")]
    chains = blocks.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(
        _chain_partition, "chain_conv bigint, chain_block bigint, choice int"
    )
    chosen = choices.join(
        chains, F.col("conv_id").eqNullSafe(F.col("chain_conv")) & (F.col("block") == F.col("chain_block"))
    )
    number = F.conv(F.hex(F.substring("choices", F.col("choice") + 1, F.lit(1))), 16, 10).cast("int")
    names = F.array(*[F.lit(r) for r in ROLES])
    found = F.element_at(names, number + 1)
    return chosen.select(
        "conv_id",
        "block",
        "turn",
        F.when(F.col("marker").isNotNull(), F.element_at(names, F.col("marker") + 1)).alias("marker"),
        F.element_at(names, number + 1).alias("role"),
        "text",
    )


def recover(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, turn, marker, role and rendered turn of every row of ``turns``.

    A role name that is no speaker's, or null, is a missing marker. Null texts count as empty; null turn numbers come first,
    in the block of turn 0; ties are ordered by marker, then text; repeated rows are turns of their own; rows with a
    null conversation form one. An empty table gives no rows. Other columns are not read.
    """
    importable(turns.sparkSession)
    found = decoded(observed(turns, key, turn, role, text), lines=False)
    return found.select("conv_id", "turn", "marker", "role", rendered(F.col("role"), F.col("text")).alias("rendered"))


def recover_lines(transcripts: DataFrame) -> DataFrame:
    """conv_id, turn, marker, role and rendered turn of every turn in transcripts (place, text) as of ``transcripts``.

    A turn starts with a block, at a marker, and where the recovered role changes; ``turn`` counts the turns of a conversation
    from 0. Turns without a marker that do not change the role are lines of the turn before them.
    """
    importable(transcripts.sparkSession)
    lines = decoded(observed_lines(transcripts), lines=True)
    block = Window.partitionBy("conv_id", "block").orderBy("turn")
    opens = F.col("marker").isNotNull() | F.coalesce(F.lag("role").over(block) != F.col("role"), F.lit(True))
    lines = lines.withColumn("opens", opens.cast("bigint")).withColumn("at", F.sum("opens").over(block))
    said = F.sort_array(F.collect_list(F.struct("turn", "text")))
    turns = lines.groupBy("conv_id", "block", "at").agg(
        F.min_by("marker", "turn").alias("marker"), F.first("role").alias("role"), said.alias("said")
    )
    # A conversation has one row per block here.
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = turns.groupBy("conv_id", "block").agg(F.count("*").alias("n")).select(
        F.col("conv_id").alias("of_conv"), F.col("block").alias("of_block"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    numbered = turns.join(earlier, F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("block") == F.col("of_block")))
    return numbered.select(
        "conv_id",
        (F.col("earlier") + F.col("at") - 1).alias("turn"),
        "marker",
        "role",
        rendered(F.col("role"), F.array_join("said.text", "")).alias("rendered"),
    )


def rendered(role: Column, text: Column) -> Column:
    """The canonical form of one turn; a conversation is its turns in order."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), F.btrim(text, F.lit(" \t\r\n")), F.lit("\n<|end|>\n"))


def conversations(recovered: DataFrame) -> DataFrame:
    """(conv_id, n_turns, text): each conversation rendered as one text, which has to fit a row."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "rendered")))
    return recovered.groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id", F.size("turns").alias("n_turns"), F.concat_ws("", F.col("turns.rendered")).alias("text")
    )
