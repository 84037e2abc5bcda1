"""Supply-chain harmonisation on Spark: two ERP systems in, two modelled entities out."""
