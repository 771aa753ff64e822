"""DataFrame operators: ordered folds, manifest algebra, events, rendering, export, graph."""
