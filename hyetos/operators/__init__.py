"""DataFrame to DataFrame operators, used unchanged by batch jobs and streams."""
