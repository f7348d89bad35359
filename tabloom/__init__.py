"""tabloom: Spark operators for preparing wide tables and selecting features.

Everything learned from data is split in two: a *fit* aggregates the train
slice down to a small table or mapping, and an *apply* is a projection built
from that fit. Only fits run Spark jobs; every apply is lazy.
"""

__version__ = "0.1.0"
