"""Row comparison shared by the tests."""

import decimal


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return decimal.Decimal(value)
    if isinstance(value, float):
        return decimal.Decimal(repr(value)).normalize()
    if isinstance(value, decimal.Decimal):
        return value.normalize() if value else decimal.Decimal(0)
    return str(value)


def canonical(columns, rows):
    """Sorted rows with columns in name order, numbers without regard to their type."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
