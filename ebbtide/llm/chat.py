"""Chat formatting of records in different layouts, with DataFrame functions only.

A record's layout is found by a fingerprint: the hash of the sorted paths of those nested fields that hold something in this
row. The fingerprint selects a declarative mapping, which lists where turns come from. A record with an unknown fingerprint gets the mapping with
the most paths among those that it holds all paths of, and ``unread`` lists what that mapping leaves; without any it keeps an empty
list of turns and a null layout. No record is dropped.

The template writes a turn as ``<s>[ROLE]role[/ROLE]text</s>``. Control strings inside roles and texts are escaped with a
backslash and a letter, backslashes likewise, so every text can be read back and no text can end a turn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.common import fresh, running

START, ROLE, ROLE_END, END = "<s>", "[ROLE]", "[/ROLE]", "</s>"
#: Control strings of this template and of common ones, escaped inside texts.
CONTROLS = (
    START, END, ROLE, ROLE_END, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
)
_MARK = "\\"
_OWN = "0"
_CODES = "abcdefghijklmnopqrstuvwxyz"[: len(CONTROLS)]
#: Names that layouts give to the roles.
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Layout:
    """Where the turns of a layout are: a list field with a role and a text path, or (role, field) pairs in order."""

    name: str
    paths: tuple[str, ...]
    turns: str | None = None
    role: str = "role"
    text: str = "text"
    fields: tuple[tuple[str, str], ...] = ()
    #: Fields joined to the one before by an empty line.
    joined: tuple[tuple[str, str], ...] = ()


LAYOUTS = (
    Layout("turns", ("turns[].role", "turns[].text"), "turns"),
    Layout("messages", ("messages[].content", "messages[].role"), "messages", text="content"),
    Layout("shared", ("conversations[].from", "conversations[].value"), "conversations", role="from", text="value"),
    Layout("prompt", ("completion", "prompt"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("chosen", ("prompt", "response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Layout("task", ("instruction", "output"), fields=(("user", "instruction"), ("assistant", "output"))),
    Layout(
        "task with input", ("input", "instruction", "output"),
        fields=(("user", "instruction"), ("assistant", "output")), joined=(("instruction", "input"),),
    ),
)


def _leaf_paths(schema: T.StructType, names: set[str]) -> list[tuple[str, Column]]:
    """Paths that layouts use and that the table has, with a column that says whether a row holds something there."""
    found = []
    for field in schema.fields:
        kind = field.dataType
        here = F.col(f"`{field.name}`")
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            for inner in kind.elementType.fields:
                path = f"{field.name}[].{inner.name}"
                if path in names:
                    # A role and a text that are null in every turn still show in the type: a list makes both paths present.
                    found.append((path, here.isNotNull()))
        elif field.name in names:
            found.append((field.name, here.isNotNull()))
    return found


def fingerprint(paths: tuple[str, ...]) -> Column:
    return F.xxhash64(F.lit(",".join(sorted(paths))))


def held_paths(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The paths that hold something in the row, in sorted order."""
    names = {p for layout in layouts for p in layout.paths}
    present = sorted(_leaf_paths(df.schema, names), key=lambda x: x[0])
    if not present:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(held, F.lit(path)) for path, held in present]))


def record_fingerprint(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of the paths that hold something in the row."""
    return F.xxhash64(F.array_join(held_paths(df, layouts), ","))


def _role(name: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    plain = F.coalesce(name, F.lit(""))
    return F.coalesce(known[plain], plain)


def _mapped(layout: Layout) -> Column:
    if layout.turns:
        return F.transform(
            F.col(layout.turns),
            lambda t: F.struct(
                _role(t[layout.role]).alias("role"), F.coalesce(t[layout.text].cast("string"), F.lit("")).alias("text")
            ),
        )
    more = dict(layout.joined)
    text = lambda f: F.concat_ws("\n\n", F.col(f), F.col(more[f])) if f in more else F.col(f)
    return F.array(*[F.struct(F.lit(r).alias("role"), text(f).cast("string").alias("text")) for r, f in layout.fields])


def canonical_turns(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``layout`` (null: unknown), ``unread`` (paths that hold something and are not in the layout) and ``turns_out`` (role, text).

    Rows are looked at one by one: repeated rows are mapped each, an empty table gives no rows. A layout's list that is empty gives no turns; null
    roles and texts are empty strings. Columns of ``df`` with the three names are replaced.
    """
    return _mapped_turns(df.drop("layout", "unread", "turns_out"), layouts, "turns_out")


def _mapped_turns(df: DataFrame, layouts: tuple[Layout, ...], out: str) -> DataFrame:
    names = {p for layout in layouts for p in layout.paths}
    have = {path for path, _ in _leaf_paths(df.schema, names)}
    # Among layouts that a row covers, the one with the most paths; of equally many, the first listed.
    usable = sorted((layout for layout in layouts if set(layout.paths) <= have), key=lambda x: -len(x.paths))
    held, mark = fresh([*df.columns, out, "layout", "unread"], "held", "print")
    marked = df.withColumn(held, held_paths(df, layouts)).withColumn(mark, record_fingerprint(df, layouts))
    turns, name, unread = F.lit(None).cast(TURNS), F.lit(None).cast("string"), F.col(held)
    covers = lambda x: F.size(F.array_except(F.array(*map(F.lit, x.paths)), F.col(held))) == 0
    tests = [(x, F.col(mark) == fingerprint(x.paths)) for x in usable] + [(x, covers(x)) for x in usable]
    for layout, fits in reversed(tests):
        turns = F.when(fits, _mapped(layout)).otherwise(turns)
        name = F.when(fits, F.lit(layout.name)).otherwise(name)
        unread = F.when(fits, F.array_except(F.col(held), F.array(*map(F.lit, layout.paths)))).otherwise(unread)
    added = {"layout": name, "unread": unread, out: F.coalesce(turns, F.array().cast(TURNS))}
    return marked.select(*[F.col(f"`{c}`") for c in df.columns], *[c.alias(n) for n, c in added.items()])


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit(_MARK), F.lit(_MARK + _OWN))
    for control, code in zip(CONTROLS, _CODES):
        out = F.replace(out, F.lit(control), F.lit(_MARK + code))
    return out


def unescaped(text: Column) -> Column:
    out = text
    for control, code in zip(CONTROLS, _CODES):
        out = F.replace(out, F.lit(_MARK + code), F.lit(control))
    return F.replace(out, F.lit(_MARK + _OWN), F.lit(_MARK))


def formatted_chats(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS, learn_from: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """The columns of ``df`` and layout, unread, pieces, formatted, loss_spans.

    ``pieces`` are the parts of ``formatted`` in order, each with its loss mark; ``loss_spans`` are the masked stretches as code points of
    ``formatted``, end exclusive. Null roles and texts are empty strings. Roles are compared with ``learn_from`` after the
    names of the layouts are unified. Repeated rows are formatted each, an empty table gives no rows. Columns of ``df`` with the five names are
    replaced.
    """
    learnt = list(learn_from)
    base = df.drop("layout", "unread", "pieces", "formatted", "loss_spans")
    out = fresh([*base.columns, "layout", "unread", "pieces", "formatted", "loss_spans"], "turns")[0]
    turns = _mapped_turns(base, layouts, out)
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    pieces = F.flatten(
        F.transform(
            out,
            lambda t: F.array(
                piece(F.concat(F.lit(START + ROLE), escaped(t["role"]), F.lit(ROLE_END)), F.lit(False)),
                piece(escaped(t["text"]), t["role"].isin(learnt)),
                piece(F.lit(END), F.lit(False)),
            ),
        )
    )
    ends = running(F.transform("pieces", lambda p: F.length(p["text"]).cast("long")), lambda a, b: a + b)
    spans = F.filter(
        F.transform(
            F.arrays_zip(F.col("pieces").alias("p"), ends.alias("e")),
            lambda x: F.struct(
                (x["e"] - F.length(x["p"]["text"])).alias("start"), x["e"].alias("end"), x["p"]["loss"].alias("loss")
            ),
        ),
        lambda s: s["loss"],
    )
    return (
        turns.withColumn("pieces", pieces)
        .withColumn("formatted", F.array_join(F.transform("pieces", lambda p: p["text"]), ""))
        .withColumn("loss_spans", F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
        .drop(out)
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted string holds."""
    chunks = F.filter(F.split(formatted, "\\Q" + END + "\\E", -1), lambda c: c != F.lit(""))
    body = lambda c: F.substr(c, F.lit(len(START + ROLE) + 1))
    return F.transform(
        F.transform(chunks, body),
        lambda b: F.struct(
            unescaped(F.substr(b, F.lit(1), F.instr(b, ROLE_END) - 1)).alias("role"),
            unescaped(F.substr(b, F.instr(b, ROLE_END) + len(ROLE_END))).alias("text"),
        ),
    )


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    masked = F.filter(pieces, lambda p: p["loss"])
    return F.array_join(F.transform(masked, lambda p: unescaped(p["text"])), "")


def turns_by_conversation(turns: DataFrame) -> DataFrame:
    """One record (conv_id, turns) of rows by turn, in order of turn, then role, then text, nulls first and kept as empty.

    Repeated turns stay, rows without a conv_id are one record, an empty table gives none; other columns are not looked at. A conversation is
    one row, so it must fit in a task's memory, as its formatted text must anyway.
    """
    row = F.struct(
        F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    return grouped.select(
        "conv_id", F.transform("_rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("turns")
    )
