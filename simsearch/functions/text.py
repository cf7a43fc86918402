"""Column expressions over subjects, labels, request texts and search hits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator of a multi-subject string, the preview length and the paper links.
SUBJECT_SEPARATOR = "; "
PREVIEW_CHARS = 300
# What counts as a label's code, as white space, and the steps of a short count.
LABEL_CODE = r"\([^)]+\)"
BLANK = r"[\s\x1c-\x1f]"
MILLION, THOUSAND = 1_000_000, 1_000
ABSTRACT_LINK = "https://arxiv.org/abs/"
PDF_LINK = "https://arxiv.org/pdf/"


def is_blank(text: Column) -> Column:
    """Empty or nothing but (Unicode) whitespace."""
    return text.rlike(r"(?U)^[\s\x1c-\x1f]*$")


def split_subjects(subjects: Column) -> Column:
    """The joined subject string as a list; empty or missing gives an empty list."""
    return F.when(F.length(subjects) > 0, F.split(subjects, SUBJECT_SEPARATOR)).otherwise(
        F.array().cast("array<string>")
    )


def clean_label(subject: Column) -> Column:
    """The name without a code in brackets at its end and without (Unicode) white space around it."""
    named = F.regexp_replace(subject, rf"(?U){BLANK}*{LABEL_CODE}{BLANK}*\z", "")
    return F.regexp_replace(named, rf"(?U)\A{BLANK}+|{BLANK}+\z", "")


def compact_count(n: Column) -> Column:
    """1500000 -> ``1M``, 1500 -> ``1k``, 15 -> ``15``; always rounded down."""
    return (
        F.when(n >= MILLION, F.concat(F.floor(n / MILLION).cast("string"), F.lit("M")))
        .when(n >= THOUSAND, F.concat(F.floor(n / THOUSAND).cast("string"), F.lit("k")))
        .otherwise(n.cast("string"))
    )


def preview(text: Column) -> Column:
    """The text, or its first 300 characters and an ellipsis when it is longer."""
    return F.when(
        F.length(text) > PREVIEW_CHARS, F.concat(F.substring(text, 1, PREVIEW_CHARS), F.lit("..."))
    ).otherwise(text)


def abstract_link(arxiv_id: Column) -> Column:
    return F.when(arxiv_id != "", F.concat(F.lit(ABSTRACT_LINK), arxiv_id))


def pdf_link(arxiv_id: Column) -> Column:
    return F.when(arxiv_id != "", F.concat(F.lit(PDF_LINK), arxiv_id, F.lit(".pdf")))
