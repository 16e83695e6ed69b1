"""Lines of statutes and judgments: which unit opens at a line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: levels of statute lines, first that fits; the first group of each is the number, if any
STATUTE_LINES = [
    ("chapter", r"(?i)^\s*CHAPTER\s+([IVXLCDM]+|\d+)\b"),
    ("part", r"(?i)^\s*PART\s+([IVXLCDM]+|[A-Z]|\d+)\b"),
    ("schedule", r"(?i)^\s*(?:THE\s+)?(?:[A-Z]+\s+)?SCHEDULE\b()"),
    ("section", r"(?i)^\s*(?:Section|Sec\.|S\.)\s*(\d+[A-Z]?(?:\.\d+)?)\b"),
    ("proviso", r"(?i)^\s*Provided\s+that\b()"),
    ("explanation", r"(?i)^\s*Explanation\b()"),
    ("sub_section", r"^\s*\((\d+)\)"),
    ("clause", r"^\s*\(([a-z])\)"),
]
# fixed values: phrases of judgment headings by class, in their order; an order must be the whole heading
JUDGMENT_HEADINGS = {
    "facts": ["facts of the case", "brief facts", "factual matrix", "the case of the prosecution"],
    "issues": ["issues for consideration", "questions of law", "points for determination"],
    "reasoning": ["analysis and reasoning", "discussion", "we have carefully considered"],
    "holding": ["holding", "in view of the above", "for the foregoing reasons", "we hold that"],
    "dissent": ["dissenting", "i am unable to agree"],
}


def statute_level(line: Column) -> Column:
    """Level that opens at a line, null for running text."""
    out = None
    for level, form in STATUTE_LINES:
        out = F.when(line.rlike(form), level) if out is None else out.when(line.rlike(form), level)
    return out


def statute_number(line: Column) -> Column:
    """Number of the unit that opens at a line, upper case; null where it has none."""
    out = None
    for _, form in STATUTE_LINES:
        number = F.nullif(F.upper(F.regexp_extract(line, form, 1)), F.lit(""))
        out = F.when(line.rlike(form), number) if out is None else out.when(line.rlike(form), number)
    return out


def heading_class(line: Column) -> Column:
    """Class of a judgment's heading, null if it is none."""
    low = F.lower(F.trim(line))
    out = None
    for name, phrases in JUDGMENT_HEADINGS.items():
        hit = F.lit(False)
        for p in phrases:
            hit = hit | F.contains(low, F.lit(p))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.when(low == "order", "order")


def without_marks(line: Column) -> Column:
    """A heading without its leading number signs, six at most."""
    return F.regexp_replace(line, "^#{1,6}[ \\t]+", "")
