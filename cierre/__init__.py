"""cierre: close-rate, KPI and financing-funnel reports as Spark DataFrame plans.

Every report is a function from DataFrames (bookings, inventory snapshots) and a
:class:`~cierre.params.Params` (one ``as_of`` date) to a long-form DataFrame.
All heavy work is declared with the DataFrame API so Catalyst/AQE choose the
physical plan; nothing is collected to the driver.
"""

from cierre.params import Params

__all__ = ["Params"]
