"""starloom: a Spark-native survey-to-star-schema engine.

Wide coded survey tables are cleaned and recoded under a declarative
specification (``starloom.spec``), validated against closed domains, split
into deduplicated dimensions with dense surrogate keys plus a fact table,
checked, published and exposed through a labelled analysis view.  Every
operator is a DataFrame transformation; nothing runs row-at-a-time in Python.
"""

from starloom.session import get_spark, reliable_checkpoint  # noqa: F401

__all__ = ["get_spark", "reliable_checkpoint"]
