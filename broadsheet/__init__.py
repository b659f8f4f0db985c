"""broadsheet: a PySpark-native engine for document and event intelligence.

Every public function takes and returns DataFrames or Columns; plans are
declared with built-in expressions so that Catalyst chooses the physical form.
"""

__version__ = "0.1.0"
