"""ledgerline: retail batch analytics, upserts and table-usage inventory on Spark.

Every operator takes DataFrames and returns DataFrames; nothing is collected
to the driver.  See README.md for the module map.
"""

from ledgerline.params import RunParams
from ledgerline.session import get_session

__all__ = ["RunParams", "get_session"]
