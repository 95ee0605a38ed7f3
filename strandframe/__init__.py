"""Sequencing reads, alignments, variants and annotation as Spark DataFrames.

``sources`` reads and writes the text formats, ``functions`` holds Column
expressions, ``operators`` holds DataFrame -> DataFrame operators and ``plans``
wires them to the driver's tables together with an oracle query for each.
"""
