from orderlens.sources.schemas import (  # noqa: F401
    ITEMS, ORDERS, PAYMENTS, PRODUCTS, REVIEWS, SCHEMAS,
)
from orderlens.sources.files import (  # noqa: F401
    Tables, load_model, read_csv, read_parquet, read_tables, register_views,
    save_model, write_csv, write_parquet,
)
from orderlens.sources.binding import bind_tables, bind_scored  # noqa: F401
