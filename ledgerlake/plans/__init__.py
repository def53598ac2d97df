"""Named queries over the driver's tables; importing this package registers them all."""

from . import books, cases, market, parsing, ruled, texts, work  # noqa: F401
