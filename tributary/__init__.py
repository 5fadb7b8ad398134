"""Record harmonisation and star-schema loading on Spark DataFrames.

Operators are plain ``DataFrame -> DataFrame`` functions meant for
``df.transform``; column helpers take and return ``Column``.
"""

__version__ = "0.1.0"
