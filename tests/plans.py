"""Physical plans as text."""

import io
from contextlib import redirect_stdout


def plan_of(frame, mode: str = "simple") -> str:
    captured = io.StringIO()
    with redirect_stdout(captured):
        frame.explain(mode)
    return captured.getvalue()
