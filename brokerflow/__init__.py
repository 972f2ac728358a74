"""brokerflow: Spark jobs that turn broker policy and claim records into a scored star schema."""
