"""Model builders: bronze (B*), silver (V*), gold graph (N*, E*), the
end-to-end pipeline, and the driver queries over the benchmark tables."""
