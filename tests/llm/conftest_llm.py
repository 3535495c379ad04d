"""Plain helpers of these tests."""


def as_rows(row):
    return tuple(str(x) for x in row)


def prose(n, start=0):
    return " ".join(f"w{(i * i + start) % 997}" for i in range(n))
