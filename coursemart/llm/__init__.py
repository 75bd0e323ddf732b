"""Training-data operators (documents and embeddings in, documents, classes, scores or token files out).

One module per operator; ``queries`` registers them. Nothing outside this package imports it.

Conventions shared by all operators:

* rows are identified by ``(doc_id, text)``: rows equal in both are one document repeated, and get the
  same result; a null ``doc_id`` is an id like any other; a null text counts as empty;
* an operator reads the columns it needs by name and never adds helper columns beside the caller's, so
  extra columns of any name pass through (stages) or are ignored (queries);
* intermediate tables are written under the cluster's shared folder (``spark.checkpoint.dir``).
"""
