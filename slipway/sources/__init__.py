from slipway.sources.seeds import (  # noqa: F401
    classified,
    conform,
    from_rows,
    literal_frame,
    read_seed,
    read_table,
    read_texts,
)
from slipway.sources import testdata  # noqa: F401
