"""Chat formatting: heterogeneous records to canonical turns, one reversible template, a loss mask.

Records are JSON-like variants in any of the layouts of :data:`LAYOUTS`.  The
set of known nested field paths that a record has is hashed; the hash selects
a declarative mapping (which paths give the turns).  Turns are rendered as

    <turn:ROLE>\\nTEXT\\n</turn>\\n

with ``\\``, ``<`` and ``>`` inside roles and texts written as ``\\b``, ``\\l``
and ``\\g``, so no text can forge a marker and parsing gives back what went
in.  The mask names, per turn, the characters of the formatted string that a
loss may count: the texts of the assistant's turns.

Only DataFrame functions: no Python runs on executors.  Offsets come from one
window per conversation that shares the exchange of the final grouping.

Defined cases: a null text is empty; a null role is the empty role; a null
turn sorts first and equal turns by role, then text; a null id is one
conversation of its own; a record whose paths no mapping knows gives null
turns, keeps its row and its conversation, and is counted there; a conversation
without turns has n_turns 0; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN, CLOSE, END = "<turn:", ">\n", "\n</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """``paths``: the nested paths whose presence marks the layout.

    Either ``items`` with its ``role`` and ``text`` fields (an array of turns),
    or ``turns``: (role, paths joined by an empty line) in order.  A role that
    starts with ``$`` is itself a path.  ``optional`` paths may be there or not.
    ``leads``: (role, path) of texts beside ``items`` that come before them
    unless they are empty or one of the items says the same.
    """

    name: str
    paths: tuple[str, ...]
    items: str | None = None
    role: str | None = None
    text: str | None = None
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()
    leads: tuple[tuple[str, str], ...] = ()


_LEADS = (("system", "$.system"), ("user", "$.prompt"))
_BESIDE = tuple(p for _, p in _LEADS)
_SYSTEM = ("system", ("$.system",))

LAYOUTS = (
    Layout("turn_row", ("$.role", "$.text"), turns=(("$.role", ("$.text",)),)),
    Layout("messages", ("$.messages", "$.messages[0].role", "$.messages[0].content"), "$.messages", "role", "content", optional=_BESIDE, leads=_LEADS),
    # none, or the first lacks a field
    Layout("no_messages", ("$.messages",), "$.messages", "role", "content", optional=("$.messages[0].role", "$.messages[0].content", *_BESIDE), leads=_LEADS),
    Layout("conversations", ("$.conversations", "$.conversations[0].from", "$.conversations[0].value"), "$.conversations", "from", "value", optional=_BESIDE, leads=_LEADS),
    Layout("no_conversations", ("$.conversations",), "$.conversations", "from", "value", optional=("$.conversations[0].from", "$.conversations[0].value", *_BESIDE), leads=_LEADS),
    Layout("instruction_input", ("$.instruction", "$.input", "$.output"), turns=(("user", ("$.instruction", "$.input")), ("assistant", ("$.output",)))),
    Layout("instruction", ("$.instruction", "$.output"), turns=(("user", ("$.instruction",)), ("assistant", ("$.output",)))),
    Layout("prompt_completion", ("$.prompt", "$.completion"), turns=(("user", ("$.prompt",)), ("assistant", ("$.completion",)))),
    Layout("prompt_response", ("$.prompt", "$.response"), turns=(("user", ("$.prompt",)), ("assistant", ("$.response",)))),
    Layout("system_prompt_response", ("$.system", "$.prompt", "$.response"), turns=(("system", ("$.system",)), ("user", ("$.prompt",)), ("assistant", ("$.response",)))),
    Layout("question_answer", ("$.question", "$.answer"), turns=(("user", ("$.question",)), ("assistant", ("$.answer",)))),
    Layout("system_instruction_input", ("$.system", "$.instruction", "$.input", "$.output"), turns=(_SYSTEM, ("user", ("$.instruction", "$.input")), ("assistant", ("$.output",)))),
    Layout("system_instruction", ("$.system", "$.instruction", "$.output"), turns=(_SYSTEM, ("user", ("$.instruction",)), ("assistant", ("$.output",)))),
    Layout("system_prompt_completion", ("$.system", "$.prompt", "$.completion"), turns=(_SYSTEM, ("user", ("$.prompt",)), ("assistant", ("$.completion",)))),
    Layout("system_question_answer", ("$.system", "$.question", "$.answer"), turns=(_SYSTEM, ("user", ("$.question",)), ("assistant", ("$.answer",)))),
)
#: roles of other layouts under their canonical names
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
KNOWN_PATHS = tuple(sorted({p for x in LAYOUTS for p in x.paths}))


def _canonical(role: Column) -> Column:
    r = F.coalesce(role, F.lit(""))
    for other, name in ROLES.items():
        r = F.when(r == other, F.lit(name)).otherwise(r)
    return r


def _at(record: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(record, path, "string"), F.lit(""))


def fingerprint(record: Column) -> Column:
    """Hash of the known nested field paths that a variant has (a field with a null value counts)."""
    have = [F.when(F.try_variant_get(record, p, "variant").isNotNull(), F.lit(p)) for p in KNOWN_PATHS]
    return F.xxhash64(F.concat_ws("|", *have))


def _path_sets() -> dict[frozenset, str]:
    """Name of the layout of every set of paths; the first layout that allows a set has it."""
    sets: dict[frozenset, str] = {}
    for x in LAYOUTS:
        for n in range(len(x.optional) + 1):
            for more in combinations(x.optional, n):
                sets.setdefault(frozenset((*x.paths, *more)), x.name)
    return sets


def _key(paths: tuple[str, ...] | frozenset) -> Column:
    return F.xxhash64(F.lit("|".join(p for p in KNOWN_PATHS if p in paths)))


def _layout_key(layout: Layout) -> Column:
    return _key(layout.paths)


def _mapping(layout: Layout, record: Column) -> Column:
    if layout.items:
        items = F.try_variant_get(record, layout.items, f"array<struct<{layout.role}:string,{layout.text}:string>>")
        said = F.transform(items, lambda t: F.struct(_canonical(t[layout.role]).alias("role"), F.coalesce(t[layout.text], F.lit("")).alias("text")))
        lead = F.array(*[F.struct(F.lit(role).alias("role"), _at(record, path).alias("text")) for role, path in layout.leads])
        return F.concat(F.filter(lead, lambda t: (t["text"] != "") & ~F.exists(said, lambda u: (u["role"] == t["role"]) & (u["text"] == t["text"]))), said)
    made = []
    for role, paths in layout.turns:
        parts = F.filter(F.array(*[_at(record, p) for p in paths]), lambda x: x != "") if len(paths) > 1 else F.array(_at(record, paths[0]))
        name = _canonical(_at(record, role)) if role.startswith("$") else F.lit(role)
        made.append(F.struct(name.alias("role"), F.array_join(parts, "\n\n").alias("text")))
    return F.array(*made)


def normalize(records: DataFrame, record_col: str = "record") -> DataFrame:
    """Add ``layout`` (its name or null) and ``turns`` to rows with a variant column."""
    key, record = F.col("_fp"), F.col(record_col)
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    sets = _path_sets()
    for x in LAYOUTS:
        mine = reduce(lambda a, b: a | b, [key == _key(paths) for paths, name in sets.items() if name == x.name])
        layout = F.when(mine, F.lit(x.name)).otherwise(layout)
        turns = F.when(mine, _mapping(x, record)).otherwise(turns)
    return records.withColumn("_fp", fingerprint(record)).withColumns({"layout": layout, "turns": turns.cast(TURNS)}).drop("_fp")


def escape(text: Column) -> Column:
    for raw, code in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def format_chats(records: DataFrame, id_col: str, order_col: str, record_col: str = "record", trained: str = "assistant") -> DataFrame:
    """One row per conversation: ``id_col``, n_turns, formatted, mask, n_unmapped.

    ``mask``: array of (turn_start, start, stop), one entry per turn in order:
    the turn begins at ``turn_start`` of ``formatted`` and characters
    [start, stop) count for the loss (none where start = stop).
    ``n_unmapped``: records of the conversation whose turns no mapping gives.
    """
    turns = normalize(records.select(id_col, order_col, record_col), record_col).select(
        F.col(id_col).alias("_id"), F.col(order_col).alias("_order"), F.col("turns").isNull().alias("_lost"), F.posexplode_outer("turns").alias("_pos", "_turn")
    )
    head = F.concat(F.lit(OPEN), escape(F.col("_turn.role")), F.lit(CLOSE))
    body = escape(F.col("_turn.text"))
    order = ["_order", "_pos", "_turn.role", "_turn.text"]
    placed = turns.withColumns({"_head": F.char_length(head), "_body": F.char_length(body), "_text": F.concat(head, body, F.lit(END))})
    w = Window.partitionBy("_id").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    length = (F.col("_head") + F.col("_body") + len(END)).cast("long")
    placed = placed.withColumns({"_n": F.row_number().over(w), "_stop": F.sum(length).over(upto)}).withColumn("_at", F.col("_stop") - length)
    counted = F.col("_turn.role") == trained
    first = F.col("_at") + F.col("_head")
    span = F.struct(
        F.col("_at").alias("turn_start"), first.alias("start"), F.when(counted, first + F.col("_body")).otherwise(first).alias("stop")
    )
    # a record without turns has one row without a turn, which collect_list leaves out
    row = F.when(F.col("_turn").isNotNull(), F.struct("_n", "_text", span.alias("_span")))
    grouped = placed.groupBy("_id").agg(F.array_sort(F.collect_list(row)).alias("_rows"), F.count_if("_lost").alias("_lost"))
    return grouped.select(
        F.col("_id").alias(id_col),
        F.size("_rows").cast("long").alias("n_turns"),
        F.array_join(F.transform("_rows", lambda r: r["_text"]), "").alias("formatted"),
        F.transform("_rows", lambda r: r["_span"]).alias("mask"),
        F.col("_lost").alias("n_unmapped"),
    )


def parse_chats(formatted: DataFrame, id_col: str) -> DataFrame:
    """Read turns and loss texts back from ``formatted`` and ``mask`` alone.

    Returns ``id_col``, turns (array of role, text), loss_texts (array of the
    unescaped texts under the mask), formatted.
    """
    pieces = F.split(F.col("formatted"), END)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    both = F.arrays_zip(pieces.alias("piece"), F.col("mask").alias("span"))

    def turn(x: Column) -> Column:
        cut = F.split(x["piece"], CLOSE, 2)
        role = F.substring(F.element_at(cut, 1), F.lit(len(OPEN) + 1), F.char_length(F.element_at(cut, 1)))
        return F.struct(unescape(role).alias("role"), unescape(F.element_at(cut, 2)).alias("text"))

    def masked(x: Column) -> Column:
        span = x["span"]
        inside = F.substring(x["piece"], (span["start"] - span["turn_start"] + 1).cast("int"), (span["stop"] - span["start"]).cast("int"))
        return unescape(inside)

    counted = F.filter(both, lambda x: x["span"]["stop"] > x["span"]["start"])
    return formatted.select(
        id_col,
        F.transform(pieces, lambda p: turn(F.struct(p.alias("piece")))).alias("turns"),
        F.transform(counted, masked).alias("loss_texts"),
        "formatted",
    )
