"""What the operators share: texts, words, held-out rows and tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.sources.work import new_work_folder, written

# A word is a run of anything but these ASCII white-space characters.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def whole_text(column: str | Column = "text") -> Column:
    """The text as it is; NULL counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """All words of ``text`` in order."""
    return F.filter(F.split(text, f"{SPACE_CLASS}+"), lambda word: word != "")


def count_words(text: Column) -> Column:
    """How many words ``text`` has, without building them: runs left after squeezing."""
    squeezed = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.regexp_replace(squeezed, f"{SPACE_CLASS}+", "")).cast("long")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text is a multiple of five. NULL counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas refer to it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


class Work:
    """Tables of one run in the folder that driver and executors share."""

    def __init__(self, spark):
        self.folder = new_work_folder(spark)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read again, so that a lost executor costs tasks and no lineage."""
        return written(df, self.path(name))

    def path(self, name: str) -> str:
        """A new place in the folder."""
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
