"""Access to formatted plans."""


def formatted(df) -> str:
    from contextlib import redirect_stdout
    from io import StringIO

    out = StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
