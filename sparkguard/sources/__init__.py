from .tables import read_table, load_transactions, load_transactions_csv  # noqa: F401
from .fixtures import transactions, transactions_dirty, scored_fixture  # noqa: F401
