SMALL = "/root/testdata/sf0.001"


def rows_of(frame):
    """The rows in an order that takes nulls."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)
