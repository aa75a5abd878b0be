"""What the tests of this folder share."""

SF = "/root/testdata/sf0.001"


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple(map(str, r)))
