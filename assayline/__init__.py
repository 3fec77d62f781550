"""assayline: medallion data-quality operators for Spark DataFrames.

Raw (Bronze) retail tables go in; keyed, typed and quality-annotated (Silver)
tables come out. Everything is a ``Column -> Column`` or
``DataFrame -> DataFrame`` function built from Spark's own expressions, so the
work stays on the executors and inside Catalyst's plan.
"""
