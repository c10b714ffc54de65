"""Text corpora as line records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: line terminators of a text file (LF, CR, CRLF), as a
# line-oriented text scan splits them.
LINE_BREAK = "\r\n|\r|\n"


def document_lines(documents: DataFrame, col: str = "text") -> DataFrame:
    """The lines a text file of these documents would hold (column ``value``).

    Every document is whole; a document's lines stay in the task that read it.
    """
    text = F.col(col)
    # Splitting on the single character LF takes Java's non-regex fast path;
    # texts that hold a CR use the full terminator pattern.
    lines = F.when(F.instr(text, "\r") == 0, F.split(text, "\n")).otherwise(F.split(text, LINE_BREAK))
    return documents.where(text.isNotNull()).select(F.explode(lines).alias("value"))
