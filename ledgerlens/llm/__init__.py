"""Training-data operators: toxicity, URL filter, secret scan, top-k search, mixing, token counts, language-model
scoring, binary token output, near-duplicate removal and benchmark decontamination.

Nothing outside this package imports it.  ``registry.load_all()`` gives the registered queries and their SQL.
"""
