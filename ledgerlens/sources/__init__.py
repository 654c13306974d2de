from ledgerlens.sources import io, tables  # noqa: F401
