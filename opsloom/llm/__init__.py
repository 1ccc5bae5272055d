"""Jobs that prepare text corpora for model training.

Each module holds one operator; `queries` registers one query per operator. Nothing else in the
library imports this subpackage.
"""
