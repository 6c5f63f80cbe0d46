"""Repair of role sequences in conversations, and their rendering."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourline.llm.common import query, running, stored, table

START, SYSTEM, USER, ASSISTANT, TOOL, OTHER = range(6)
ROLES = ("", "system", "user", "assistant", "tool")
STATES = 5
# Which turn may follow which: a system turn only first, then user and assistant in turn, tools behind an assistant.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER, TOOL), TOOL: (ASSISTANT,)}
ALIASES = {
    "human": USER, "prompter": USER, "customer": USER, "bot": ASSISTANT, "gpt": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT,
    "function": TOOL, "developer": SYSTEM,
} | {name: i for i, name in enumerate(ROLES) if name}
MERGE, RELABEL, NAME, INSERT = 2, 5, 3, 4  # costs; NAME is for giving an unknown role a legal one
BLOCK = 1 << 14
FAR = 1 << 40


def role_of(name: str | None) -> int:
    return ALIASES.get((name or "").strip().lower(), OTHER)


def _steps() -> list[list[list[tuple[int, int, str, int]]]]:
    """For each role of a turn and each state before it: (state after, cost, action, inserted role or 0)."""
    out = []
    for role in range(6):
        per_state = []
        for state in range(STATES):
            options = []
            as_role = lambda r, role=role: 0 if r == role else NAME if role == OTHER else RELABEL
            for after in LEGAL[state]:
                options.append((after, as_role(after), "keep" if after == role else "relabel", 0))
            if state != START:
                options.append((state, MERGE + as_role(state), "merge", 0))
            for between in LEGAL[state]:
                for after in LEGAL[between]:
                    options.append((after, INSERT + as_role(after), "keep" if after == role else "relabel", between))
            per_state.append(options)
        out.append(per_state)
    return out


STEPS = _steps()
# Turns inserted behind the last one, so that every conversation ends with the assistant.
ENDING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: (), TOOL: (ASSISTANT,)}


def forward(roles: list[int], costs: list[int]) -> tuple[list[int], list[list]]:
    """Least costs per state after the turns, from those before, and each turn's best (state before, step) per state."""
    back = []
    for role in roles:
        new, choice = [FAR] * STATES, [None] * STATES
        for state in range(STATES):
            if costs[state] < FAR:
                for step in STEPS[role][state]:
                    if costs[state] + step[1] < new[step[0]]:
                        new[step[0]], choice[step[0]] = costs[state] + step[1], (state, step)
        costs = new
        back.append(choice)
    return costs, back


def end_costs(costs: list[int]) -> list[int]:
    return [c + INSERT * len(ENDING[s]) for s, c in enumerate(costs)]


def walk(roles: list[int], first: int, last: int | None) -> list[tuple[int, int, str, int]]:
    """The cheapest steps from state `first` to state `last`, or to the cheapest ending."""
    costs, back = forward(roles, [0 if s == first else FAR for s in range(STATES)])
    if last is None:
        ends = end_costs(costs)
        last = ends.index(min(ends))
    steps = []
    for choice in reversed(back):
        last, step = choice[last]
        steps.append(step)
    return steps[::-1]


def _matrices(batches):
    """(block key, costs of the block from each state to each) for rows sorted by conversation, block and position."""
    at, roles = None, []

    def row():
        return (*at, [c for s in range(STATES) for c in forward(roles, [0 if x == s else FAR for x in range(STATES)])[0]])

    for batch in batches:
        rows = []
        for conv, block, role in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (conv, block) != at:
                if at is not None:
                    rows.append(row())
                at, roles = (conv, block), []
            roles.append(role)
        yield _batch(rows, [pa.string(), pa.int64(), pa.list_(pa.int64())], ["conv", "block", "costs"])
    if at is not None:
        yield _batch([row()], [pa.string(), pa.int64(), pa.list_(pa.int64())], ["conv", "block", "costs"])


def _batch(rows, kinds, names):
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _borders(blocks: DataFrame) -> DataFrame:
    """(conv, block, first, last): the states between the blocks of conversations of several blocks, one row of 25
    costs for every 16,384 turns of those. Found per conversation, on Spark."""
    def per_conversation(batches):
        at, held = None, []

        def solved():
            costs, back = [0] + [FAR] * (STATES - 1), []
            for _, matrix in held:
                options = [[(costs[s] + matrix[s * STATES + t], s) for s in range(STATES)] for t in range(STATES)]
                back.append([min(o)[1] for o in options])
                costs = [min(o)[0] for o in options]
            ends = end_costs(costs)
            last = ends.index(min(ends))
            out = []
            for (block, _), choice in zip(reversed(held), reversed(back), strict=True):
                out.append((at, block, choice[last], last))
                last = choice[last]
            return out

        for batch in batches:
            rows = []
            for conv, block, costs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv != at:
                    rows += solved() if held else []
                    at, held = conv, []
                held.append((block, costs))
            yield _batch(rows, [pa.string(), pa.int64(), pa.int32(), pa.int32()], ["conv", "block", "first", "last"])
        if held:
            yield _batch(solved(), [pa.string(), pa.int64(), pa.int32(), pa.int32()], ["conv", "block", "first", "last"])

    return blocks.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(per_conversation, "conv string, block long, first int, last int")


def _solved(batches):
    """Rows (conv, block, role, first, last, final, position, ...) sorted: the step chosen for each turn."""
    at, held = None, []

    def rows():
        first, last, final = held[0][1:4]
        steps = walk([h[0] for h in held], first or START, None if final else last)
        return [(at[0], h[4], ROLES[s[0]], s[2], ROLES[s[3]] or None, s[1]) for h, s in zip(held, steps, strict=True)]

    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32()]
    names = ["conv", "position", "new_role", "action", "inserted", "cost"]
    for batch in batches:
        out = []
        for conv, block, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (conv, block) != at:
                out += rows() if held else []
                at, held = (conv, block), []
            held.append(rest)
        yield _batch(out, kinds, names)
    if held:
        yield _batch(rows(), kinds, names)


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations made legal at least cost, as segments: conv, position, part, turn, role, action, cost, segment.

    A legal conversation is an optional system turn, then user and assistant turns that alternate, tools answering assistants, the
    assistant last. A turn may be kept, relabelled, merged into the turn before, or follow an inserted empty turn; dynamic programming over
    the last role finds the cheapest way. Long conversations are cut into blocks: each block's costs from every state to every state
    are worked out apart, their borders are chosen, and every block is solved between its borders.

    Segments in order of position and part (0 inserted before the turn, 1 the turn, 2 inserted at the end) make up the rendered text;
    a merged turn continues its predecessor's segment, so no conversation is ever put together in memory. NULL and unknown roles are
    given a legal one, NULL texts are empty; turns of equal number are ordered by a hash of role and text, NULL numbers last;
    a NULL conversation id is one conversation. An empty table gives no rows. Other columns are dropped.
    """
    spark = df.sparkSession
    known = F.lower(F.trim(F.coalesce(F.col(role), F.lit(""))))
    code = F.lit(OTHER)
    for name, value in ALIASES.items():
        code = F.when(known == name, value).otherwise(code)
    keyed = df.select(
        F.col(conv).alias("conv_id"), F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("")).alias("conv"),
        F.col(turn).alias("turn"), F.col(turn).isNull().alias("last_turn"), code.cast("int").alias("code"),
        F.xxhash64(role, text, F.col(role).isNull(), F.col(text).isNull()).alias("stamp"), F.col(text).alias("text"),
    ).withColumn("turn_key", F.coalesce(F.col("turn").cast("string"), F.lit("")))
    order = [F.col("last_turn"), F.col("turn"), F.col("stamp")]
    ranked = running(keyed.drop("text"), ["conv"], order, {"n": F.lit(1).cast("bigint")}, "turns")
    ranked, _ = stored(ranked.select(
        "conv", "turn_key", "stamp", "code", F.col("n__before").alias("position"), F.col("n__all").alias("turns"),
        F.expr(f"n__before div {BLOCK}L").alias("block")), "turns-ranked")
    long = ranked.where(F.col("turns") > BLOCK)
    blocks = long.repartition("conv", "block").sortWithinPartitions("conv", "block", "position").select(
        "conv", "block", "code").mapInArrow(_matrices, "conv string, block long, costs array<long>")
    borders, _ = stored(_borders(blocks), "turn-borders")
    solved = (
        ranked.join(borders, ["conv", "block"], "left")
        .withColumn("final", F.col("position") - F.col("position") % BLOCK + BLOCK >= F.col("turns"))
        .repartition("conv", "block").sortWithinPartitions("conv", "block", "position")
        .select("conv", "block", "code", "first", "last", "final", "position")
        .mapInArrow(_solved, "conv string, position long, new_role string, action string, inserted string, cost int")
    )
    steps = ranked.join(solved, ["conv", "position"])
    # Turns of equal conversation, number, role and text share one text, so that texts move once, by the join's own key.
    same = Window.partitionBy("conv", "turn_key", "stamp").orderBy(F.lit(0))
    texts = keyed.select("conv_id", "conv", "turn", "turn_key", "stamp", "text").withColumn("nth", F.row_number().over(same))
    rows = texts.where("nth = 1").join(steps.drop("code", "block"), ["conv", "turn_key", "stamp"])
    end, head = F.lit("<|end|>\n"), lambda r: F.concat(F.lit("<|"), r, F.lit("|>\n"))
    closing = F.when(F.col("position") == 0, "").otherwise(end)
    body = F.coalesce("text", F.lit(""))
    final = F.col("position") == F.col("turns") - 1
    opening = F.when(F.col("action") == "merge", F.lit("\n\n")).otherwise(
        F.concat(F.when(F.col("inserted").isNull(), closing).otherwise(end), head(F.col("new_role"))))
    turn_part = F.struct(
        F.lit(1).alias("part"), "turn", F.col("new_role").alias("role"), "action", "cost",
        F.concat(opening, body, F.when(final, end).otherwise("")).alias("segment"))
    none = F.lit(None).cast(dict(keyed.dtypes)["turn"]).alias("turn")

    def empty(part, name, before):
        return F.struct(F.lit(part).alias("part"), none, name.alias("role"), F.lit("insert").alias("action"),
                        F.lit(0 if part == 0 else INSERT).alias("cost"), F.concat(before, head(name)).alias("segment"))

    nothing = F.array().cast("array<struct<part:int,turn:%s,role:string,action:string,cost:int,segment:string>>" % dict(keyed.dtypes)["turn"])
    inserted = F.when(F.col("inserted").isNotNull(), F.array(empty(0, F.col("inserted"), closing))).otherwise(nothing)
    tails = nothing
    for state, roles in ENDING.items():
        if roles:
            added = [F.struct(F.lit(2 + i).alias("part"), none, F.lit(ROLES[r]).alias("role"), F.lit("insert").alias("action"), F.lit(INSERT).alias("cost"),
                              F.lit(f"<|{ROLES[r]}|>\n<|end|>\n").alias("segment")) for i, r in enumerate(roles)]
            tails = F.when(final & (F.col("new_role") == ROLES[state]), F.array(*added)).otherwise(tails)
    out = rows.select("conv_id", "position", F.explode(F.concat(inserted, F.array(turn_part), tails)).alias("s"))
    return out.select(F.col("conv_id").alias(conv), "position", "s.part", F.col("s.turn").alias(turn), F.col("s.role").alias("role"), "s.action", "s.cost", "s.segment")


@query("op2_chat")
def op2(spark, sf_dir):
    return repair(table(spark, sf_dir, "conversations"))
