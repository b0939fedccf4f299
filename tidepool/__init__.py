"""tidepool: a Spark-native medallion pipeline.

Raw lake ingest -> one-pass quality gate -> typed staging -> star schema
(dimensions + facts) -> business marts -> constraint suite -> batch audit.
Every stage is a DataFrame transformation; the driver only ever sees
one-row metric results.
"""

__version__ = "0.1.0"
