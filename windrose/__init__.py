"""Regional disruption intelligence from vehicle telemetry, as Spark DataFrame operators."""
