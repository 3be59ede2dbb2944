"""Queries over the given tables; importing the package registers them all."""

from ledgerline.plans import audits, files, indicators, loading, naming, printed, products, published, quality, reading, status, streams, tariffs  # noqa: F401
