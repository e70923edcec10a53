"""Column-name rules: cleanup of given names, and a label for columns that have none."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that give an unnamed column its label. The first list with a word anywhere in
# the lower-cased sample text wins; number columns are labelled between the two groups.
WORDS_BEFORE_NUMBERS = (
    ("address", ("street", "avenue", "road", "drive", "lane", "boulevard")),
    ("zipcode", ("zip", "postal")),
    ("city", ("city", "town")),
    ("state", ("state", "province")),
    ("phone", ("phone", "tel", "mobile")),
    ("email", ("email", "@")),
    ("url", ("http", "www", ".com", ".org")),
)
WORDS_AFTER_NUMBERS = (
    ("description", ("description", "detail", "note", "comment")),
    ("name", ("name", "title")),
    ("id", ("id", "identifier", "code")),
)
DATE_MARKS = ("date", "/", "-")
DATE_SAMPLE_LENGTH = 12
AMOUNT_ABOVE = 1000
SAMPLE_SIZE = 10


def clean_header(name: str) -> str:
    """Trimmed, line breaks and tabs as underscores, runs of blanks as one blank."""
    return re.sub(r"\s+", " ", re.sub(r"[\n\r\t]", "_", name.strip())).strip()


def identifier(name: str) -> str:
    return re.sub(r"[ .-]", "_", name)


def lacks_name(header: str) -> bool:
    return header in ("", "nan") or header.lower().startswith(("unnamed:", "column_"))


def distinct_names(names: list[str], mark: str = "_", fold_case: bool = True) -> list[str]:
    """Number repeated names: `b, b` becomes `b, b_1`. Spark compares names without case."""
    key = str.lower if fold_case else str
    taken, result = set(), []
    given = {key(n) for n in names}
    for name in names:
        new, n = name, 0
        while key(new) in taken or (n and key(new) in given):
            n += 1
            new = f"{name}{mark}{n}"
        taken.add(key(new))
        result.append(new)
    return result


def file_header(cells: list[str | None]) -> list[str]:
    """Header cells of a delimited file: a placeholder for empty ones, `.1`, `.2` for repeats."""
    cells = [c.lstrip("﻿") if i == 0 and c else c for i, c in enumerate(cells)]
    named = [c if c else f"Unnamed: {i}" for i, c in enumerate(cells)]
    return distinct_names(named, mark=".", fold_case=False)


def is_date_name(name: str) -> bool:
    return "date" in name.lower() or "time" in name.lower()


def _any_word(text: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower({text}), '{w}')" for w in words) + ")"


def _label_rules(text: str, rules: tuple[tuple[str, tuple[str, ...]], ...]) -> str:
    return " ".join(f"WHEN {_any_word(text, words)} THEN '{name}'" for name, words in rules)


def label_before_numbers(sample: str) -> Column:
    """Label by the words that count for every type of column, else null."""
    return F.expr(f"CASE {_label_rules(sample, WORDS_BEFORE_NUMBERS)} END")


def label_after_numbers(sample: str, first: str) -> Column:
    """Label of a column that holds no numbers."""
    is_date = f"{_any_word(sample, DATE_MARKS)} AND length({first}) <= {DATE_SAMPLE_LENGTH}"
    return F.expr(f"CASE {_label_rules(sample, WORDS_AFTER_NUMBERS)} WHEN {is_date} THEN 'date' ELSE 'field' END")
