"""DataFrame operators: staging, intermediate models, marts and the analytics built on them."""
