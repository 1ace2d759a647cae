"""Training-data operators: thirteen corpus operators and the pipeline built on them.

Nothing else in the library imports this subpackage; the registry of its
queries is ``ebbtide.llm.queries`` and their SQL ``ebbtide.llm.oracle``.
"""
