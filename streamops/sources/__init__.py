"""Sources: driver tables, canonical sensor views, text, generator, Kafka."""
