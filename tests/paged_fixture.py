"""A table that most tests of paged files use."""

from stratamend.functions.types import Field
from stratamend.sources.pagewriter import Builder, data_page, integer, record, row, varying  # noqa: F401

INT_KEY = Field(9, 0, 4, offset=4)
INT_VALUE = Field(9, 0, 4, offset=8)


def simple(path, pages, generation=1, **more):
    """A table T (ID key, VALOR) of (generation, slots) pages."""
    return Builder(path, generation=generation, **more).table(130, "T", [("ID", INT_KEY), ("VALOR", INT_VALUE)], ["ID"], pages=pages).write()


def live(txn, key, value=None, flags=0, back=(0, 0), **more):
    return record(txn, row([INT_KEY, INT_VALUE], [integer(key), integer(value)]), flags, 1, back, **more)
