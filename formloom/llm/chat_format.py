"""Chat formatting: transcripts to turns, roles by a hidden Markov model, and their canonical rendering.

A transcript is cut into segments at lines that begin with a speaker marker and after blank lines. States are roles. A
segment is observed as its marker (the name that its first line begins with, if any) and features of its lines: how
long it is and how many lines it has. Rates are counted on turns of known roles; Viterbi's algorithm then finds the
likeliest roles of a conversation.

A conversation of any length is cut into ranges of segments. The best path through a range from each state to each
is a matrix in the (max, +) algebra; matrices of a conversation are chained to find the states at the cuts, in a tree
where there are many, and each range is then decoded by itself. So no task holds more than a range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.llm.shared import Scratch

ROLES = ("system", "user", "assistant", "tool", "other")
# Names that speakers go by.
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "customer", "client", "me", "you", "question", "q"),
    "assistant": ("assistant", "ai", "bot", "agent", "model", "answer", "a"),
    "tool": ("tool", "function", "observation", "result"),
}
RANGE = 256  # turns of a conversation that one task holds
N_MARKERS, N_LENGTHS, N_LINES = len(MARKERS) + 1, 16, 6
N_SYMBOLS = N_MARKERS * N_LENGTHS * N_LINES
NAMES = "|".join(n for names in MARKERS.values() for n in sorted(names, key=len, reverse=True))
HEAD = rf"(?i)^\s*[\[<(*#|]*\s*({NAMES})\s*[\]>)*|]*\s*[:>]\s*"


def role_index(role: Column) -> Column:
    """Place of a role among ROLES; aliases count, anything else is 'other', null stays null."""
    name = F.lower(F.trim(role))
    found = F.when(name.isNull(), F.lit(None).cast("int"))
    for k, r in enumerate(ROLES[:-1]):
        found = found.when(name.isin(r, *MARKERS[r]), F.lit(k))
    return found.otherwise(F.lit(len(ROLES) - 1))


def symbol(text: Column) -> Column:
    """The observation of a turn, as one number."""
    t = F.coalesce(text, F.lit(""))
    name = F.lower(F.regexp_extract(t, HEAD, 1))
    marker = F.lit(0)
    for k, names in enumerate(MARKERS.values()):
        marker = F.when(name.isin(*names), F.lit(k + 1)).otherwise(marker)
    length = F.least(F.lit(N_LENGTHS - 1), F.floor(F.log2(F.length(t) + 1)).cast("int"))
    lines = F.least(F.lit(N_LINES - 1), F.regexp_count(t, F.lit("\n")).cast("int"))
    return (marker * N_LENGTHS + length) * N_LINES + lines


class RoleModel:
    """Log rates of first roles, of role after role and of symbol by role."""

    def __init__(self, first: np.ndarray, after: np.ndarray, seen: np.ndarray):
        self.first = np.log((first + 1) / (first + 1).sum())
        self.after = np.log((after + 1) / (after + 1).sum(axis=1, keepdims=True))
        # a symbol's parts are taken as independent given the role; a marker is trusted before it is seen
        cells = seen.reshape(len(ROLES), N_MARKERS, N_LENGTHS, N_LINES)
        marker, shape = cells.sum(axis=(2, 3)) + 0.5, cells.sum(axis=1) + 0.05
        for k in range(len(MARKERS)):
            marker[k, k + 1] += 50 + 0.2 * marker[k].sum()
        marker, shape = marker / marker.sum(axis=1, keepdims=True), shape / shape.sum(axis=(1, 2), keepdims=True)
        self.seen = (np.log(marker)[:, :, None, None] + np.log(shape)[:, None]).reshape(len(ROLES), N_SYMBOLS)

    def matrix(self, symbols: list[int]) -> np.ndarray:
        """[i, j]: the best path from state i before the turns to state j at the last of them."""
        best = np.full((len(ROLES),) * 2, -np.inf)
        np.fill_diagonal(best, 0.0)
        for s in symbols:
            best = (best[:, :, None] + self.after[None]).max(axis=1) + self.seen[:, s]
        return best

    def begin(self, symbols: list[int]) -> np.ndarray:
        """[j]: the best path of a conversation that begins with the turns, to state j at the last of them."""
        score = self.first + self.seen[:, symbols[0]]
        for s in symbols[1:]:
            score = (score[:, None] + self.after).max(axis=0) + self.seen[:, s]
        return score

    def decode(self, symbols: list[int], before: int | None = None, last: int | None = None) -> list[int]:
        """The likeliest roles; before: the state of the turn before (None: the conversation begins), last: that of the last turn."""
        score = (self.first if before is None else self.after[before]) + self.seen[:, symbols[0]]
        back = []
        for s in symbols[1:]:
            ways = score[:, None] + self.after
            back.append(ways.argmax(axis=0))
            score = ways.max(axis=0) + self.seen[:, s]
        path = [int(score.argmax()) if last is None else last]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


def train(turns: DataFrame) -> RoleModel:
    """Counts over all turns of known role: (conv_id, turn, symbol, role_index). Only counts, of a fixed number, reach the driver."""
    known = turns.where("role_index is not null")
    seen, after, first = np.zeros((len(ROLES), N_SYMBOLS)), np.zeros((len(ROLES),) * 2), np.zeros(len(ROLES))
    for r in known.groupBy("role_index", "symbol").agg(F.count("*").alias("n")).collect():
        seen[r.role_index, r.symbol] = r.n
    # the next turn by its number: an equi-join, so a long conversation isn't gathered
    ahead = known.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role_index").alias("next_index")).distinct()
    for r in known.select("conv_id", "turn", "role_index").distinct().join(ahead, ["conv_id", "turn"]).groupBy("role_index", "next_index").agg(F.count("*").alias("n")).collect():
        after[r.role_index, r.next_index] = r.n
    begin = known.groupBy("conv_id").agg(F.min(F.struct("turn", "role_index")).alias("m"))
    for r in begin.groupBy("m.role_index").agg(F.count("*").alias("n")).collect():
        first[r.role_index] = r.n
    return RoleModel(first, after, seen)


TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<double>": pa.list_(pa.float64())}


def in_ranges(rows: DataFrame, columns: list[str], body, schema: str) -> DataFrame:
    """Applies body to the rows of each (conv_id, part), in order of seq; one range is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and (row["conv_id"], row["part"]) != (held[0]["conv_id"], held[0]["part"]):
                    out += body(held)
                    held = []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, result)
        if held:
            yield pa.RecordBatch.from_pylist(body(held), result)

    result = pa.schema([(n, TYPES[t]) for n, t in (f.split() for f in schema.split(", "))])
    return rows.select("conv_id", "part", "seq", *columns).repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(run, schema)


def numbered(rows: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """Adds seq, a number that follows the order within each conversation, and part, which at most RANGE rows share.

    Rows are sorted by ranges, so a conversation may lie in many tasks; rows alike in all are dealt by chance. The numbers
    are written, as another run may give others.
    """
    chance = F.rand(5).alias("chance")
    sorted_rows = rows.select("*", chance).repartitionByRange("conv_id", *order, "chance").sortWithinPartitions("conv_id", *order, "chance").drop("chance")
    return scratch.written(sorted_rows.withColumn("seq", F.monotonically_increasing_id()).withColumn("part", F.floor(F.col("seq") / RANGE).cast("long")), "numbered")


SIZE = len(ROLES)


def product(rows: list[dict]) -> list[float]:
    """The matrix of ranges one after the other, and the vector of a conversation that begins with them."""
    whole, begin = np.array(rows[0]["m"][: SIZE * SIZE]).reshape(SIZE, SIZE), np.array(rows[0]["m"][SIZE * SIZE :])
    for r in rows[1:]:
        m = np.array(r["m"][: SIZE * SIZE]).reshape(SIZE, SIZE)
        whole, begin = (whole[:, :, None] + m[None]).max(axis=1), (begin[:, None] + m).max(axis=0)
    return [*whole.reshape(-1).tolist(), *begin.tolist()]


def chained(rows: list[dict], before: int | None, last: int | None) -> list[dict]:
    """The states before and at the end of each range (place, m), given those around them all (None: the conversation begins, or ends)."""
    matrices = [np.array(r["m"][: SIZE * SIZE]).reshape(SIZE, SIZE) for r in rows]
    score, back = np.array(rows[0]["m"][SIZE * SIZE :]) if before is None else matrices[0][before], []
    for m in matrices[1:]:
        ways = score[:, None] + m
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0)
    path = [int(score.argmax()) if last is None else last]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    path = path[::-1]
    return [{"conv_id": r["conv_id"], "place": r["seq"], "before": path[k - 1] if k else before, "last": path[k]} for k, r in enumerate(rows)]


STEPS, ENDS = "conv_id long, seq long, m array<double>", "conv_id long, place long, before int, last int"


def range_ends(steps: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, place, before, last) of every range, of their matrices (conv_id, seq, m); place is the range's seq."""
    steps = scratch.written(steps, "steps")
    placed = steps.withColumn("part", F.floor(F.col("seq") / RANGE).cast("long"))
    several = placed.groupBy("conv_id").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    if several.isEmpty():
        return in_ranges(placed, ["m"], lambda rows: chained(rows, None, None), ENDS)
    coarse = in_ranges(placed, ["m"], lambda rows: [{"conv_id": rows[0]["conv_id"], "seq": rows[0]["part"], "m": product(rows)}], STEPS)
    ends = range_ends(coarse, scratch).withColumnsRenamed({"conv_id": "end_id", "place": "end_part"})
    both = placed.join(ends, F.col("conv_id").eqNullSafe(F.col("end_id")) & (F.col("part") == F.col("end_part")))
    return in_ranges(both, ["m", "before", "last"], lambda rows: chained(rows, rows[0]["before"], rows[0]["last"]), ENDS)


def format_chats(conversations: DataFrame, model: RoleModel | None = None, conv_column: str = "conv_id", turn_column: str = "turn", text_column: str = "text", role_column: str | None = "role") -> DataFrame:
    """One row per turn: conv_id, turn, role (as given), found_role, rendered.

    Roles are found from the texts and their order alone; role_column trains the model where none is given. A
    null text counts as empty; turns without a conversation are one of their own; a null turn number comes first, turns
    of one number go by text, repeated rows follow each other. A very long text is observed like any other. Other
    columns are not read; an empty table gives no rows. A rendered turn is <|role|>, the text without its marker and
    outer white space, <|end|>.
    """
    role = F.col(role_column).cast("string") if role_column else F.lit(None).cast("string")
    turns = conversations.select(F.col(conv_column).cast("long").alias("conv_id"), F.col(turn_column).cast("long").alias("turn"), F.lit(0).cast("long").alias("segment"), F.coalesce(F.col(text_column), F.lit("")).alias("text"), role.alias("role"))
    return found_roles(turns, train(observed(turns)) if model is None else model).drop("segment")


def observed(turns: DataFrame) -> DataFrame:
    """Turns with their observation and the place of their role."""
    return turns.withColumn("symbol", symbol(F.col("text"))).withColumn("role_index", role_index(F.col("role")))


def found_roles(turns: DataFrame, model: RoleModel) -> DataFrame:
    """(conv_id, turn, segment, text, role) with found_role and rendered."""
    scratch = Scratch(turns.sparkSession)
    turns = numbered(turns.withColumn("symbol", symbol(F.col("text"))), ["turn", "segment", "text"], scratch)

    def step(rows: list[dict]) -> list[dict]:
        symbols = [r["symbol"] for r in rows]
        return [{"conv_id": rows[0]["conv_id"], "seq": rows[0]["part"], "m": [*model.matrix(symbols).reshape(-1).tolist(), *model.begin(symbols).tolist()]}]

    def find(rows: list[dict]) -> list[dict]:
        found = model.decode([r["symbol"] for r in rows], rows[0]["before"], rows[0]["last"])
        return [{"conv_id": r["conv_id"], "turn": r["turn"], "segment": r["segment"], "role": r["role"], "text": r["text"], "found": k} for r, k in zip(rows, found, strict=True)]

    # only conversations of several ranges need their matrices
    long = turns.groupBy("conv_id").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select(F.col("conv_id").alias("long_id"))
    cut_up = turns.join(long, F.col("conv_id").eqNullSafe(F.col("long_id")), "left_semi")
    ends = scratch.written(range_ends(in_ranges(cut_up, ["symbol"], step, STEPS), scratch), "ends").withColumnRenamed("conv_id", "end_id")
    placed = turns.join(ends, F.col("conv_id").eqNullSafe(F.col("end_id")) & (F.col("part") == F.col("place")), "left")
    found = in_ranges(placed, ["turn", "segment", "text", "symbol", "role", "before", "last"], find, "conv_id long, turn long, segment long, role string, text string, found int")
    name = F.get(F.array(*map(F.lit, ROLES)), F.col("found"))
    return found.select("conv_id", "turn", "segment", "role", name.alias("found_role"), rendered(name, F.col("text")).alias("rendered"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), F.regexp_replace(F.regexp_replace(text, HEAD, ""), r"^\s+|\s+$", ""), F.lit("\n<|end|>"))


def segments(raw: Column) -> Column:
    """The segments of a raw transcript: each begins at a line with a speaker marker or after a blank line. None in a null or blank text."""
    marked = F.regexp_replace(raw, "(?m)" + HEAD.replace(r"^\s*", r"^[ \t]*"), "\u0001$0")
    return F.filter(F.split(marked, "\u0001|\\n[ \\t]*\\n"), lambda x: x.rlike(r"\S"))


def split_transcripts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Raw transcripts as turns (conv_id, turn, text). format_chats, with a model that train() made, then finds the roles."""
    return docs.select(F.col(id_column).cast("long").alias("conv_id"), F.posexplode(segments(F.col(text_column))).alias("turn", "text"))


# How a speaker's name may stand in a raw transcript; %s is the name.
STYLES = ("%s: ", "%s:\n", "[%s]: ", "### %s: ", "**%s**: ")


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, raw): conversations as they would stand in raw text, a piece of transcript a turn.

    A speaker goes by one of the names of the role, in one of STYLES, or, one time in four, by none: such a turn begins
    after a blank line. A conversation is the pieces in order; it is never gathered into one text, which has no bound.
    """
    draw = lambda n, salt: F.pmod(F.xxhash64("conv_id", "turn", F.lit(salt)), F.lit(n)).cast("int")
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    name = F.lit(None).cast("string")
    for role, names in MARKERS.items():
        name = F.when(F.lower(F.trim("role")) == role, F.get(F.array(*(F.lit(n.title()) for n in names)), draw(len(names), 1))).otherwise(name)
    style = F.get(F.array(*map(F.lit, STYLES)), draw(len(STYLES), 2))
    head = F.when((draw(4, 3) > 0) & name.isNotNull(), F.replace(style, F.lit("%s"), name)).otherwise(F.lit("\n\n"))
    return turns.select("conv_id", "turn", "role", F.concat(head, "text").alias("raw"))


def parse_transcripts(raw: DataFrame, model: RoleModel) -> DataFrame:
    """(conv_id, turn, segment, role, found_role, rendered) of pieces of transcripts (conv_id, turn, role, raw); role isn't read, only passed on.

    A piece without a segment (null or blank) is one blank segment. Repeated pieces follow each other.
    """
    parts = segments(F.col("raw"))
    parts = F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("")))
    rows = raw.select("conv_id", "turn", "role", F.posexplode(parts).alias("segment", "text"))
    return found_roles(rows.select("conv_id", "turn", F.col("segment").cast("long").alias("segment"), "text", "role"), model)


def held_out(conv_id: Column) -> Column:
    """Conversations that the model isn't trained on: one in five, by a hash of the id."""
    return F.coalesce(F.crc32(conv_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def parsed_conversations(conversations: DataFrame) -> DataFrame:
    """Conversations as raw transcripts, parsed again: conv_id, turn, segment, held_out, role (as given), found_role, rendered.

    The model is trained on the conversations that aren't held out; roles are found from raw text alone. Other columns
    are not read; an empty table gives no rows.
    """
    raw = raw_transcripts(conversations)
    known = raw.where(~held_out(F.col("conv_id"))).select("conv_id", "turn", F.col("raw").alias("text"), "role")
    found = parse_transcripts(raw, train(observed(known)))
    return found.select("conv_id", "turn", "segment", held_out(F.col("conv_id")).alias("held_out"), "role", "found_role", "rendered")
