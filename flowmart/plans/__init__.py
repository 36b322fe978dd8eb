"""Plans: raw layer to staging, marts, serving queries and model outputs."""
