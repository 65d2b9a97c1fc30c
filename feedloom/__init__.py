"""feedloom: Spark-native tables for feeds that land small files on a schedule.

Raw CSV / TSV / zipped / JSON landings become typed, de-duplicated, day-partitioned
Parquet tables; the usual time-series questions (per hour, per day, series, top groups,
shares) and audits (gaps, cast loss, duplicates, layout) run as DataFrame plans over them.
"""

__version__ = "0.1.0"
