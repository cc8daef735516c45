"""Text expressions: Markdown code-fence stripping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fence patterns.  Leading/trailing blanks go first and last;
# an opening fence may carry the tag ``sql`` in any case; a closing fence must end the text.
OUTER_BLANKS = r"^\s+|\s+$"
OPENING_FENCE = r"(?i)^```(?:sql)?\s*"
CLOSING_FENCE = r"\s*```$"


def strip_fences(c: str | Column) -> Column:
    """Remove one outer Markdown code fence (```` ```sql ```` … ```` ``` ````) from SQL text.

    Fences in the middle of the text stay.  ``trim`` would strip spaces only, so
    the outer blanks are removed with a regular expression (tabs, newlines too).
    """
    x = F.col(c) if isinstance(c, str) else c
    x = F.regexp_replace(x, OUTER_BLANKS, "")
    x = F.regexp_replace(x, OPENING_FENCE, "")
    x = F.regexp_replace(x, CLOSING_FENCE, "")
    return F.regexp_replace(x, OUTER_BLANKS, "")
