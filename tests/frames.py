"""What the tests share besides the session: the smallest data, rows as tuples."""

SMALL = "/root/testdata/sf0.001"


def values(frame, *columns):
    """Rows as a sorted list of tuples, NULL first."""
    chosen = frame.select(*columns) if columns else frame
    return sorted(
        (tuple(r) for r in chosen.collect()),
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )
