import collections

from cinderspark.plans import inputs

DATA = "/root/testdata/sf0.001"


def flooded(cells):
    """``(y, smallest cell number): cells`` of each 8-connected group, by flood fill."""
    left, found = set(cells), {}
    for start in sorted(cells):
        if start not in left:
            continue
        left.remove(start)
        todo, n = [start], 0
        while todo:
            y, r, c = todo.pop()
            n += 1
            near = {(y, r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1)} & left
            left -= near
            todo.extend(near)
        y, r, c = start
        found[y, (y * 64 + r) * 64 + c] = n
    return found


def test_areas_of_every_year(spark):
    import __spark_entry__ as entry

    cells = {(x["y"], x["r"], x["c"]) for x in inputs.burnt(spark, DATA).collect()}
    got = {(x["y"], x["component"]): x["cells"] for x in entry.queries()["components_area"](spark, DATA).collect()}
    assert got == flooded(cells)
    assert len({y for y, _ in got}) > 1
    per_year = collections.Counter()
    for (y, _), n in got.items():
        per_year[y] += n
    assert per_year == collections.Counter(y for y, _, _ in cells)
