"""Node labels of a RED-decorated tree, taken apart with built-in string functions.

A label is a genome id, a bootstrap value, taxon names, or bootstrap and taxa joined by a colon
inside quotes; a suffix after a pipe carries the RED value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of a label.
RED_SUFFIX = r"\|[^']+"
RED_VALUE = r"(?<=\|RED=)[0-9]\.[0-9]{1,3}"
BOOTSTRAP = r"^[0-9]\.[0-9]{1,3}$"
BOOTSTRAP_BEFORE_TAXA = r"(?<=')[0-9]\.[0-9]{1,3}(?=:)"
TAXA_AFTER_BOOTSTRAP = r"(?<=:).*(?=')"
GENOME = r"[^']+"
# The same numbers of any length.
LONG_RED_VALUE = r"(?<=\|RED=)[0-9]+(?:\.[0-9]+)?"
LONG_BOOTSTRAP = r"^[0-9]+(?:\.[0-9]+)?$"
LONG_BOOTSTRAP_BEFORE_TAXA = r"(?<=')[0-9]+(?:\.[0-9]+)?(?=:)"


def without_red(label: Column) -> Column:
    """The label without its RED suffix; quotes stay only around bootstrap:taxa pairs."""
    bare = F.regexp_replace(label, RED_SUFFIX, "")
    return F.when(F.contains(bare, F.lit(":")), bare).otherwise(F.replace(bare, F.lit("'"), F.lit("")))


def bootstrap(label: Column, full: bool = False) -> Column:
    bare = without_red(label)
    pair = F.regexp_substr(bare, F.lit(LONG_BOOTSTRAP_BEFORE_TAXA if full else BOOTSTRAP_BEFORE_TAXA))
    return (
        F.when(F.contains(bare, F.lit(":")), pair)
        .when(bare.rlike(LONG_BOOTSTRAP if full else BOOTSTRAP), bare)
        .try_cast("double")
    )


def taxa(label: Column) -> Column:
    bare = without_red(label)
    return F.when(
        F.contains(bare, F.lit(":")), F.regexp_substr(bare, F.lit(TAXA_AFTER_BOOTSTRAP))
    ).when(F.contains(bare, F.lit("__")), bare)


def genome(label: Column, full: bool = False) -> Column:
    bare = without_red(label)
    number = bare.rlike(LONG_BOOTSTRAP if full else BOOTSTRAP)
    other = F.contains(bare, F.lit(":")) | number | F.contains(bare, F.lit("__"))
    return F.when(~other, F.regexp_substr(bare, F.lit(GENOME)))


def red(label: Column, full: bool = False) -> Column:
    """RED as written in the label, at most three decimals unless ``full``; null without a RED suffix."""
    return F.regexp_substr(label, F.lit(LONG_RED_VALUE if full else RED_VALUE)).try_cast("double")


def label_columns(label: Column, full: bool = False) -> dict[str, Column]:
    """Parts of a label. Numbers have one digit and up to three decimals, as tree files write them; a longer RED is cut and
    a longer bootstrap taken for a name, which ``label_issue`` tells. ``full`` reads numbers of any length."""
    return {
        "RED": red(label, full),
        "bootstrap": bootstrap(label, full),
        "taxa": taxa(label),
        "genome": genome(label, full),
    }


def label_issue(label: Column) -> Column:
    """What is lost of a label's numbers: ``red_cut``, ``number_as_genome``, ``bootstrap_lost``, or null."""
    number, usual = r"[0-9]+(?:\.[0-9]+)?", r"[0-9]\.[0-9]{1,3}"

    def lost(before: str, after: str) -> Column:
        return label.rlike(before + number + after) & ~label.rlike(before + usual + after)

    return (
        F.when(lost(r"\|RED=", r"(?![0-9.])"), "red_cut")
        .when(lost("^'?", r"'?(?:\||$)"), "number_as_genome")
        .when(lost("^'", ":"), "bootstrap_lost")
    )
