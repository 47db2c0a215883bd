"""byteloom: hex telemetry decoding as Spark DataFrame plans.

Telemetry rows carry diagnostic messages as hex strings.  Layouts, conversion
tables and expected lengths are data; decoding is a join of messages with
those small tables followed by built-in column expressions.
"""

__version__ = "0.1.0"
