"""Training-data operators: ten batch operators over documents, embeddings and pages.

Nothing outside this subpackage imports it; queries and SQL are in
``cinelake.llm.queries``.
"""
