"""Plans: the end-to-end batch pipeline and the registered queries over the driver's tables."""
