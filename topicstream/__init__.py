"""Find and follow news topics in a stream of short posts, on Spark."""
