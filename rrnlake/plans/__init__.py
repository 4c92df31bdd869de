"""Plan building blocks: durable cuts, global order, sizes, quantiles."""
