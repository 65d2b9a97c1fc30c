"""Training-data operators: fingerprints, de-duplication, token counts, chat formatting, quality and mixing.

Every operator takes a DataFrame and column names, and returns a DataFrame that keeps the other columns
of its input; an input column with the name of an output column (in any case) is replaced. Python runs
inside tasks only, on Arrow batches (Spark bounds a batch at 64 MB), and works through each batch in blocks.
"""
