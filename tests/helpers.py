from __future__ import annotations

import contextlib
import io


def plan_text(df, mode: str = "formatted") -> str:
    """The text ``DataFrame.explain`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
