from slipway.store.store import (  # noqa: F401
    ConcurrentChange,
    NothingToRevert,
    Snapshot,
    Store,
    Version,
    Written,
)
