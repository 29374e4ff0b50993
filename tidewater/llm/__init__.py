"""Operations of a large-scale training-data pipeline.

Thirteen operators over documents, conversations and embeddings, each a module
of its own; ``queries`` applies them to the given tables. Nothing outside
this subpackage imports it.
"""
