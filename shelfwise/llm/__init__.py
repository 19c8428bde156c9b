"""Training-data operators: extraction, search, filtering, mixing, encoding.

Each module holds one operator with its own general interface; ``queries``
binds them to the ``pages``, ``embeddings``, ``documents``, ``labels`` and
``benchmark`` tables.  Nothing outside this folder imports it.
"""
