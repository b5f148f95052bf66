"""Training-data operators: quality rules, deduplication, chat formatting, language-model
scoring, WARC archives, secret scans, packing and benchmark decontamination.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries only when
it can be imported.
"""
