"""Composed operators: flatten/nest, assembly, cleaning, augmentation, sentiment."""
