"""tellstar: Spark-native star-schema pipeline for question-answering evaluation telemetry.

Layers (each a set of ``DataFrame -> DataFrame`` functions):

* ``sources``   – landing-file scans, seed lookups, versioned table IO
* ``operators`` – landing semantics, data-quality checks, join/aggregate building blocks
* ``functions`` – ``Column`` helpers (surrogate keys, model family, JSON extraction, cost math)
* ``plans``     – staging, intermediate, marts and report relations
* ``streaming`` – incremental landing driven by a file-source stream
"""

__version__ = "0.1.0"
