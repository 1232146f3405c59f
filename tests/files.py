import os


def put(folder, name, text="k\n1\n", at=None):
    """Write a small file, with this modification time if given."""
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)
    if at is not None:
        os.utime(path, (at, at))
    return path


def as_set(df):
    """All rows of a DataFrame as tuples, in an order of their own."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
