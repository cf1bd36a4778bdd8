"""Fill-in-middle transformation by counted-quantifier regular expressions.

``regexp_count`` counts a text's units (code points, or whatever ``unit`` matches).
Two cuts a <= b come from a seeded hash of the id.  The pattern of a row holds its
own counts, ``unit{a}`` and ``unit{b-a}``, both possessive, so the one match of
the whole text captures prefix, middle and suffix without ever going back,
and the replacement writes them in the order of the row's form.  All of it is
built-in column functions; nothing is shuffled.

Forms: ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) and
``plain`` (the text as it is).  A text that is empty or holds a marker stays plain, and so does
the share of rows outside ``rate``; of the others ``spm_rate`` are ``spm``.  Texts
that are cut hold no marker, and no marker overlaps itself or another, so the
first occurrence of each in the output is the one that was written: ``restore``
needs output and form alone.

Defined cases: a null text is an empty one; a null id is hashed as the empty string;
equal ids are cut by the same hashes; repeated rows give repeated results; texts are
taken whole, whatever their length (counts stay below 2^31, as Spark's strings do);
units that do not cover the text (``unit`` may be any pattern) leave the rest to the
suffix; further columns stay out unless named in ``keep``, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty


@dataclass(frozen=True)
class Settings:
    """Markers, unit, seed and shares (percent) of one transformation."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    unit: str = "."
    seed: int = 1
    rate: int = 90
    spm_rate: int = 20

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        # an occurrence that overlaps a written marker lies in it, or an end of one begins another
        within = any(x != y and x in y for x in marks for y in marks)
        if within or len(set(marks)) < 3 or any(y.startswith(x[i:]) for x in marks for y in marks for i in range(1, len(x))):
            raise ValueError(f"markers must be different and must not overlap one another: {marks}")
        if not all(marks) or any(c in m for m in marks for c in "\\$"):
            raise ValueError(f"markers must not be empty and must hold neither \\ nor $: {marks}")
        if not (0 <= self.rate <= 100 and 0 <= self.spm_rate <= 100):
            raise ValueError("rate and spm_rate are percentages")

    def order(self, form: str) -> tuple[tuple[str, int], ...]:
        """(marker, captured group) in the order of a form; groups are 1 prefix, 2 middle, 3 suffix."""
        p, s, m = (self.prefix, 1), (self.suffix, 3), (self.middle, 2)
        return (p, s, m) if form == "psm" else (s, p, m)


def _hashes(id_col: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of sha256("seed:id") as unsigned integers."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``keep`` columns, text, n, form, prefix_chars, middle_chars (null if plain), output."""
    s = settings or Settings()
    rows = docs.select(
        F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"), F.struct(*[F.col(c) for c in keep] or [F.lit(0)]).alias("_kept")
    )
    h1, h2, h3, h4 = _hashes(F.col("_id"), s.seed)
    marked = F.greatest(*[F.contains("_text", F.lit(m)) for m in (s.prefix, s.suffix, s.middle)])
    form = F.when((F.col("_text") == "") | marked | (h3 % 100 >= s.rate), "plain").when(h4 % 100 < s.spm_rate, "spm").otherwise("psm")
    rows = rows.withColumns({"_n": F.regexp_count("_text", F.lit(f"(?s){s.unit}")).cast("long"), "_form": form})
    one, two = h1 % (F.col("_n") + 1), h2 % (F.col("_n") + 1)
    cut = F.col("_form") != "plain"
    rows = rows.withColumns({"_a": F.when(cut, F.least(one, two)), "_m": F.when(cut, F.abs(one - two))})
    unit = s.unit if s.unit == "." else f"(?:{s.unit})"
    pattern = F.format_string(f"(?s)\\A({_literal(unit)}{{%d}}+)({_literal(unit)}{{%d}}+)(.*+)\\z", "_a", "_m")
    replacement = F.when(F.col("_form") == "spm", _replacement(s, "spm")).otherwise(_replacement(s, "psm"))
    output = F.when(~cut, F.col("_text")).otherwise(F.regexp_replace("_text", pattern, replacement))
    return rows.select(
        F.col("_id").alias("doc_id"), *[F.col("_kept")[c].alias(c) for c in keep], F.col("_text").alias("text"), F.col("_n").alias("n"),
        F.col("_form").alias("form"), F.col("_a").alias("prefix_chars"), F.col("_m").alias("middle_chars"), output.alias("output"),
    )


def _literal(pattern: str) -> str:
    """A pattern inside a format string."""
    return pattern.replace("%", "%%")


def _replacement(s: Settings, form: str) -> Column:
    return F.lit("".join(f"{marker}${group}" for marker, group in s.order(form)))


def restore(output: str | Column, form: str | Column, settings: Settings | None = None) -> Column:
    """The text that ``transform`` was given, from its output and form alone."""
    s = settings or Settings()
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    back = output
    for name in ("psm", "spm"):
        order = s.order(name)
        parts = "".join(f"\\Q{marker}\\E({'.*+' if i == 2 else '.*?'})" for i, (marker, _) in enumerate(order))
        # the captured groups stand in written order; put them back as prefix, middle, suffix
        place = {group: i + 1 for i, (_, group) in enumerate(order)}
        back = F.when(form == name, F.regexp_replace(output, F.lit(f"(?s)\\A{parts}\\z"), F.lit("".join(f"${place[g]}" for g in (1, 2, 3))))).otherwise(back)
    return back


__all__ = ["Settings", "restore", "transform"]
